"""Steps that several operators share: prefix sums, components of links, comparing pairs of texts.

All keep their state in Spark tables.  Nothing that grows with the documents reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import write_down

# Members of one centre that share a task in `compare_pairs`.
FAN = 256


def prefix_sums(df: DataFrame, groups: list[str], order: list[Column], values: dict[str, Column],
                partitions: int | None = None) -> DataFrame:
    """Exclusive running sums of `values` within each group, in the given order, over any number of tasks.

    Rows are range-sorted by (groups, order) and written down with their range; sums within a range
    start from the totals of the ranges before it.  Only one row per range and group is summed in a
    single task, so a group with most of the rows is no bottleneck.  `order` must end in something
    that tells rows apart; rows equal in all of it are interchangeable.  Null is a group like others.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = {f"_o{i}": c for i, c in enumerate(order)}
    keys = [F.col(c).asc_nulls_last() for c in groups] + [F.col(c).asc_nulls_last() for c in named]
    ranged = df.select("*", *(c.alias(k) for k, c in named.items()), *(c.alias(f"_v_{k}") for k, c in values.items()))
    ranged = write_down(ranged.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range", *groups).agg(*(F.sum(f"_v_{k}").alias(f"_t_{k}") for k in values))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_range").alias("_r"), *(F.col(c).alias(f"_g_{c}") for c in groups),
        *(F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in values))
    inside = (Window.partitionBy("_range", *groups).orderBy(*(F.col(c).asc_nulls_last() for c in named))
              .rowsBetween(Window.unboundedPreceding, -1))
    running = ranged.select("*", *(F.coalesce(F.sum(f"_v_{k}").over(inside), F.lit(0)).alias(f"_s_{k}") for k in values))
    match = F.col("_range") == F.col("_r")
    for c in groups:
        match &= F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return (running.join(offsets, match)
            .select(*df.columns, *((F.col(f"_s_{k}") + F.col(f"_b_{k}")).alias(k) for k in values)))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable over undirected links (a, b); nodes without links are absent.

    Alternates large-star and small-star steps, which halve the depth of every tree, until the
    links no longer change.  Minima are aggregated before the shuffle; no node's links are gathered.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e, seen = write_down(e), None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        seen = state
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = write_down(moved.union(lower).distinct())


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal leading columns, of a sorted stream; callers bound the runs."""
    held, at = [], None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if row[:keys] != at:
                if held:
                    yield at, held
                held, at = [], row[:keys]
            held.append(row[keys:])
    if held:
        yield at, held


def compare_pairs(pairs: DataFrame, docs: DataFrame, key: str, text: str,
                  prepare: Callable[[bytes | None], object],
                  judge: Callable[[object, object, int, int, object], Iterator[tuple]],
                  schema: pa.Schema, sql_schema: str, note: str = "string") -> DataFrame:
    """Run `judge` on the texts of pairs (a, b, note), where a is a centre that may have any number of partners.

    Each text that a pair asks for is fetched by one join.  The partners of a centre are dealt to
    tasks by (centre, salt), about FAN each, with the centre's text once in each; a task streams its
    sorted rows and holds one prepared centre, which also stands for its copies.  judge(centre, member, a, b, note) yields result rows.
    """
    fans = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("fans"))
    members = pairs.join(fans, "a").select(
        F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("fans")).cast("int").alias("salt"),
        F.lit(1).alias("role"), F.col("note").cast(note).alias("note"))
    centres = fans.select(
        F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("salt"),
        F.lit(0).alias("role"), F.lit(None).cast(note).alias("note"))
    texts = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    rows = (texts.join(centres.union(members).hint("shuffle_hash"), "id")
            .repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
            .select("a", "salt", "role", "id", "note", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, whole, at = None, None, None
        for batch in batches:
            out = []
            columns = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                a, salt, role, other, said, body = (c[i].as_py() for c in columns)
                if role == 0:
                    if at != (a, salt):
                        centre, whole, at = prepare(body), body, (a, salt)
                elif at == (a, salt):
                    out.extend(judge(centre, centre if body == whole else prepare(body), a, other, said))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, sql_schema)
