"""Balanced shards that keep linked documents together, by label propagation under quotas.

Only DataFrame functions.  Documents with equal texts are linked; every document starts in the shard its
key hashes to and linked documents move towards the shard most of their neighbours are in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.spread import prefix_sums
from clickloom.session import write_down

SHARDS = 16
ROUNDS = 3


def _chosen(value: Column, table: list) -> Column:
    """table[value], for a table with one entry per shard."""
    return F.element_at(F.array(*(F.lit(x).cast("long") for x in table)), value.cast("int") + 1)


def _places(sizes: list[tuple[int, int]], share: list[int]) -> list[tuple[int, int, int]]:
    """(unit, end, shard): rows of the unit up to the end go to the shard; whole units where one has room for them."""
    free, out = list(share), []
    for unit, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        at = 0
        while at < n:
            room = [s for s in range(len(free)) if free[s] >= n - at]
            to = min(room, key=lambda s: free[s]) if room else max(range(len(free)), key=lambda s: free[s])
            took = min(free[to], n - at)
            free[to] -= took
            at += took
            out.append((unit, at, to))
    return out


def balanced_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
                    rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of docs, by the law `rows`.

    Shards differ by one row at most and slots are gapless from 0.  In each round the units (documents with
    equal texts) vote by counting members per shard; members elsewhere move to the winner as far as its quota
    allows, whole units at a time.  Only a group larger than a shard's share is cut, or one that no
    shard has room for.  Groups of at least a quarter of a share, 4 * shards at most, are placed first, the
    largest first.  A last pass over distributed ranks moves what exceeds a shard's exact share, unlinked
    documents first, into the free slots of others.

    Null texts count as empty for size and checksum and are not linked; null keys hash like any value.
    Repeated rows are documents of their own.  An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = write_down(docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.when(F.col(text).isNotNull(), F.xxhash64(F.col(text))).alias("print")))
    total = base.count()
    if total == 0:
        return base.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    share = [total // shards + (s < total % shards) for s in range(shards)]
    alike = ["print", "text_crc32", "size"]
    groups = base.where("print is not null").groupBy(*alike).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    groups = write_down(groups.withColumn("unit", F.xxhash64(*alike)))
    placed = (base.join(groups, alike, "left")
              .withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(shards)).cast("int")).drop("members", "print"))
    placed = write_down(placed)
    # No more than 4 * shards groups are that large.
    large = groups.groupBy("unit").agg(F.sum("members").alias("n")).where(F.col("n") * 4 >= max(share)).collect()
    places = _places([(r.unit, r.n) for r in large], share)
    held = [0] * shards
    alone = placed.where("unit is null").withColumn("first", F.lit(1))
    linked = placed.where("unit is not null")
    if places:
        is_large = F.col("unit").isin([r.unit for r in large])
        to, start = F.lit(None).cast("int"), {}
        for unit, end, shard in places:
            held[shard] += end - start.get(unit, 0)
            start[unit] = end
        for unit, end, shard in reversed(places):
            to = F.when((F.col("unit") == unit) & (F.col("nth") < end), F.lit(shard)).otherwise(to)
        numbered = prefix_sums(linked.where(is_large), ["unit"], [F.col("doc_id")], {"nth": F.lit(1).cast("long")})
        alone = alone.unionByName(numbered.withColumn("shard", to).drop("nth").withColumn("first", F.lit(0)))
        linked = linked.where(~is_large)

    for step in range(rounds):
        votes = linked.groupBy("unit", "shard").agg(F.count(F.lit(1)).alias("n"))
        wanted = votes.groupBy("unit").agg(
            F.max(F.struct("n", F.xxhash64("unit", "shard").alias("tie"), "shard"))["shard"].alias("target"))
        voted = linked.join(wanted, "unit")
        # One row per pair of shards: what is there and what wants to go where.  Unlinked documents give
        # way at the end, so they take up no quota.
        flows = voted.groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n")).collect()
        stay, come = list(held), [0] * shards
        for f in flows:
            (stay if f.shard == f.target else come)[f.target] += f.n
        if not any(come):
            break
        quota = [min(1.0, max(0, share[s] - stay[s]) / come[s]) if come[s] else 0.0 for s in range(shards)]
        draw = F.pmod(F.xxhash64("unit", F.lit(step)), F.lit(1_000_000))
        linked = write_down(voted.withColumn("shard", F.when(
            draw < _chosen(F.col("target"), [round(q * 1_000_000) for q in quota]), F.col("target")).otherwise(F.col("shard")))
            .drop("target"))

    everyone = write_down(alone.unionByName(linked.withColumn("first", F.lit(1))))
    ranked = prefix_sums(everyone, ["shard"], [F.col("first"), F.col("unit"), F.col("doc_id"), F.col("size"), F.col("text_crc32")],
                         {"rank": F.lit(1).cast("long")})
    have = [0] * shards
    for r in everyone.groupBy("shard").count().collect():
        have[r["shard"]] = r["count"]
    spare_before, free_before = [0], [0]
    for s in range(shards):
        spare_before.append(spare_before[-1] + max(0, have[s] - share[s]))
        free_before.append(free_before[-1] + max(0, share[s] - have[s]))
    here, rank = F.col("shard"), F.col("rank")
    moved = F.when(rank >= _chosen(here, share), rank - _chosen(here, share) + _chosen(here, spare_before[:shards]))
    to = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        to = F.when(F.col("moved") < free_before[s + 1], F.lit(s)).otherwise(to)
    fill = F.col("moved") - _chosen(F.col("to"), free_before[:shards]) + _chosen(F.col("to"), have)
    return (ranked.withColumn("moved", moved).withColumn("to", F.when(F.col("moved").isNull(), here).otherwise(to))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("to").cast("int").alias("shard"),
                    F.when(F.col("moved").isNull(), rank).otherwise(fill).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
