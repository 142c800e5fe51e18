"""Session settings the library relies on, and how to get a session for local work."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in the library assumes.  All can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: str | int = "*", app: str = "clickloom", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture doubles the time to build a plan and only serves error messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as the session names it.

    Only a local session may fall back on a temporary folder: on a cluster that folder
    would be lost with its machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is not None:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4()}"


def write_down(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several branches of a plan read.

    The rows are written to the shared checkpoint folder and read back as Parquet: they
    are computed once, survive the loss of executors, and each branch reads only the
    columns it needs.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
