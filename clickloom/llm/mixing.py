"""Mixing sources to target weights, with exact word budgets over distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.spread import prefix_sums
from clickloom.session import write_down

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"


def _targets(sources: DataFrame, share: float, repeats: int, weights: tuple) -> DataFrame:
    """(source, source_size, target): weights dealt by name, targets stopped at `repeats` times a source.

    Sharing what lies above the stops again and again ends at the level L where the targets
    min(stop, weight * L) meet the total.  In order of stop / weight, L is the largest of
    (total - stops before) / (weight from here on), which prefix sums give.
    """
    numbered = prefix_sums(sources, [], [F.col("source")], {"place": F.lit(1).cast("long")}, partitions=1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1).cast("long")
    stops = write_down(numbered.select("source", "source_size", weight.alias("weight"),
                                       (F.col("source_size") * repeats).alias("stop")))
    size, whole = stops.agg(F.sum("source_size"), F.sum("weight")).first()
    if not whole:
        return stops.select("source", "source_size", F.lit(0.0).alias("target"))
    level = prefix_sums(stops, [], [F.col("stop") / F.col("weight"), F.col("source")],
                        {"stops": F.col("stop"), "weights": F.col("weight")}, partitions=1).agg(
        F.max((F.lit(size * share) - F.col("stops")) / (F.lit(whole) - F.col("weights")))).first()[0]
    return stops.select("source", "source_size", F.least(
        F.col("stop").cast("double"), F.col("weight").cast("double") * F.lit(level)).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", share: float = SHARE,
        repeats: int = REPEATS, weights: tuple = WEIGHTS) -> DataFrame:
    """(doc_id, source, print, size, source_size, target, taken) for every row of docs.

    Size is the number of words.  Each source's budget is its target in whole words; full epochs take
    every document once more, and the rest is cut from the documents in the order of a hash of their key
    where the running sum meets the budget, so one document per source may be taken in part.

    Null or empty texts have size 0 and are taken 0 times; a null source is the last source; null keys
    order last.  Repeated rows count each by itself.  An empty table gives no rows.
    """
    sized = write_down(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), F.md5(F.col(text).cast("binary")).alias("print"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    targets = _targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, repeats, weights)
    budget = F.floor(F.col("target") + 0.5)
    targets = write_down(targets.select(F.col("source").alias("_source"), "source_size", "target",
                                        F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).alias("epochs"),
                                        budget.alias("budget")))
    order = [F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id"), F.col("print")]
    running = prefix_sums(sized, ["source"], order, {"before": F.col("size")})
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("before")))
    return (running.join(targets, F.col("source").eqNullSafe(F.col("_source")))
            .select("doc_id", "source", "print", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of the mix, with the columns of docs: each document as often as it is taken, a last one cut to its words.

    Rows equal in key, text and source are taken together, with the other columns of one of them.  Documents taken
    0 times are left out.  Rows without key are told apart by text and source.  Other columns may have any names.
    """
    taken = (mix(docs, key, text, source, **options).groupBy("doc_id", "print", "source")
             .agg(F.sum("taken").alias("taken"), F.max("size").alias("size")).where("taken > 0")
             .withColumnsRenamed({"doc_id": "mix_id", "print": "mix_print", "source": "mix_source"}))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("id"), F.md5(F.col(text).cast("binary")).alias("print"),
                       F.col(source).alias("from"))
    same = (F.col("id").eqNullSafe(F.col("mix_id")) & F.col("print").eqNullSafe(F.col("mix_print"))
            & F.col("from").eqNullSafe(F.col("mix_source")))
    whole, left = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    turns = rows.join(taken, same).dropDuplicates(["id", "print", "from"]).withColumn(
        "turn", F.explode(F.sequence(F.lit(1).cast("long"), whole + F.when(left > 0, 1).otherwise(0))))
    body = F.col("row").getField(text)
    cut = F.array_join(F.slice(F.regexp_extract_all(body, F.lit(f"({WORD})"), F.lit(1)), 1, left.cast("int")), " ")
    turns = turns.withColumn("body", F.when(F.col("turn") > whole, cut).otherwise(body))
    new = {text: F.col("body")} | {c: F.length("body").cast(t) for c, t in docs.dtypes if c == "n_chars"}
    return turns.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
