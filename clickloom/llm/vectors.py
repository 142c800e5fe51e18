"""Near-duplicate vectors by sorted projection passes.

In each pass vectors are sorted by a concatenation of random hashes.  A hash is the signed direction,
out of a random set, that a vector is closest to; close vectors mostly share it.  Neighbours in the
sorted order are compared in blocks, and so are all vectors with equal hashes, however many.  The links of
all passes give components; inside a component every pair is compared, so that links are counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.spread import components, sorted_groups
from clickloom.session import write_down

THRESHOLD = 0.93
PASSES, HASHES, DIRECTIONS = 8, 4, 64
BLOCK = 128
SEED = 20240905


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def usable(column: str) -> F.Column:
    """Whether an array holds only finite numbers, and not only zeros."""
    c = F.col(column)
    good = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & good & F.exists(c, lambda x: x != 0), F.lit(False))


def codes(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """(pass, code, label, dim, node, vector): one row per vector and pass."""
    schema = pa.schema([("pass", pa.int32()), ("code", pa.int64()), ("label", pa.string()), ("dim", pa.int32()),
                        ("node", pa.int64()), ("vector", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                if dim not in directions:
                    draws = np.random.default_rng([seed, int(dim)])
                    directions[dim] = draws.standard_normal((passes, HASHES, int(dim), DIRECTIONS))
                unit = _unit(np.frombuffer(b"".join(part.column(3).to_pylist()), np.float64).reshape(part.num_rows, dim))
                for p in range(passes):
                    code = np.zeros(part.num_rows, np.int64)
                    for h in range(HASHES):
                        along = unit @ directions[dim][p, h]
                        near = np.abs(along).argmax(axis=1)
                        sign = along[np.arange(len(near)), near] < 0
                        code = code * (2 * DIRECTIONS) + 2 * near + sign
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(part.num_rows, p), pa.int32()), pa.array(code), part.column(0), part.column(2),
                         part.column(1), part.column(3)], schema=schema)

    return classes.select("label", "node", "dim", "vector").mapInArrow(
        run, "pass int, code long, label string, dim int, node long, vector binary")


def _pack(frame: DataFrame) -> DataFrame:
    """The array column as the bytes of doubles."""
    schema = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("vector", pa.binary()), ("vec_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) + 0.0 for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(r) for r in rows], pa.int32()),
                 pa.array([r.tobytes() for r in rows], pa.binary()), batch.column(2)], schema=schema)

    return frame.mapInArrow(run, "label string, dim int, vector binary, vec_id long")


def _alike(vectors: list[bytes], others: list[bytes], threshold: float) -> np.ndarray:
    x, y = (_unit(np.frombuffer(b"".join(v), np.float64).reshape(len(v), -1)) for v in (vectors, others))
    return x @ y.T >= threshold


def linking_edges(classes: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES, block: int = BLOCK,
                  seed: int = SEED) -> DataFrame:
    """(a, b): links that connect all nodes of one label and dimension found to have at least that cosine.

    Compared are each block of the sorted order with itself and the next, and all blocks that a run of
    equal codes spans.  Each comparison gives a star per set of nodes it connects, not every pair.
    """
    order = ["pass", "label", "dim", "code", "node"]
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (codes(classes, passes, seed).repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_range", F.spark_partition_id())
              .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    ranged = write_down(ranged)
    starts = (ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(
        F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n"))
    rows = ranged.join(starts, "_range").withColumn("block", F.floor((F.col("start") + F.col("_at")) / block))
    run_key = ["pass", "label", "dim", "code"]
    runs = rows.groupBy(*run_key).agg(F.min("block").alias("low"), F.max("block").alias("high"))
    reach = write_down(rows.select("block", *run_key).distinct().join(runs, run_key).groupBy("block").agg(
        F.min("low").alias("low"), F.max("high").alias("high")))
    last = reach.agg(F.max("block")).first()[0] or 0
    sent = rows.join(reach, "block").select(
        "block", F.explode(F.sequence(F.least("low", F.greatest(F.lit(0), F.col("block") - 1)),
                                      F.greatest("high", F.least(F.lit(last), F.col("block") + 1)))).alias("other"),
        "pass", "label", "dim", "node", "vector")
    keys = ["left", "right", "pass", "label", "dim"]
    sent = (sent.select(F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), *keys[2:], "node", "vector")
            .repartition("left", "right").sortWithinPartitions(*keys, "node"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in sorted_groups(batches, len(keys)):
            vectors, nodes = [r[1] for r in held], np.array([r[0] for r in held])
            linked = _alike(vectors, vectors, threshold)
            np.fill_diagonal(linked, True)
            least, before = nodes, None
            while before is None or (least != before).any():
                before = least
                least = np.where(linked, least[None, :], np.iinfo(np.int64).max).min(axis=1)
            far = least != nodes
            if far.any():
                yield pa.RecordBatch.from_arrays([pa.array(least[far]), pa.array(nodes[far])], schema=schema)

    return sent.mapInArrow(compare, "a long, b long").distinct()


def linked_rows(members: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(node, linked): the rows of all linked nodes, from (component, label, dim, node, rows, vector).

    All members of a component are compared, in pairs of blocks that are dealt to tasks; each gives one
    sum per node, so no pair leaves its task.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    sent = (members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("component", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
                    (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "rows", "vector")
            .repartition("component", "left", "right").sortWithinPartitions("component", "left", "right", "side", "node"))
    schema = pa.schema([("node", pa.int64()), ("linked", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, left, right), held in sorted_groups(batches, 3):
            sides = [[r for r in held if r[0] == s] for s in (0, 1)]
            if left == right:
                sides[1] = sides[0]
            if not sides[0] or not sides[1]:
                continue
            linked = _alike(*([r[3] for r in side] for side in sides), threshold)
            if left == right:
                np.fill_diagonal(linked, False)
            nodes, rows = (([np.array([r[i] for r in side]) for side in sides]) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[0]), pa.array(linked @ rows[1])], schema=schema)
            if left != right:
                yield pa.RecordBatch.from_arrays([pa.array(nodes[1]), pa.array(linked.T @ rows[0])], schema=schema)

    return sent.mapInArrow(compare, "node long, linked long").groupBy("node").agg(F.sum("linked").alias("linked"))


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of the table.

    Vectors of equal, non-null label are linked if their cosine in double precision is at least the
    threshold.  Equal vectors are one node; n_links counts the rows of linked nodes and the other rows of the own
    node.  A vector that is null, empty, zero or holds null or non-finite components, a null label or a
    null key links with nothing; vectors of different length do not link.  An empty table gives no rows.
    """
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                        F.col(vector).cast("array<double>").alias("vector"))
    fit = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector"))
    packed = write_down(_pack(fit.select("label", "vector", "vec_id")))
    same = ["label", "dim", "vector"]
    classes = write_down(packed.groupBy(*same).agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("rows")))
    found = write_down(components(linking_edges(classes, threshold, **options)))
    degrees = linked_rows(classes.join(found, "node"), threshold)
    known = (classes.join(degrees, "node", "left").join(found, "node", "left")
             .select(*same, (F.coalesce("linked", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    member = packed.join(known, same).select(F.col("vec_id").alias("_id"), "n_links", "component_id").distinct()
    return (rows.select("vec_id").join(member, F.col("vec_id") == F.col("_id"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
