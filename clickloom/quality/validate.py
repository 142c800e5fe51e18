"""Running suites: one scan per table, however many checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import count_where, round_half_away, safe_divide
from clickloom.operators import orphan_keys
from clickloom.quality.expectations import (
    OVER_ALL_ROWS,
    REFERENCES,
    TABLE_CHECKS,
    UNIQUE,
    Expectation,
    Suite,
)
from clickloom.quality.observe import observe, outcome

EXAMPLES = 10
RESULT_COLUMNS = ["suite_name", "dataset", "check_no", "expectation_type", "column", "success", "element_count",
                  "missing_count", "unexpected_count", "unexpected_percent"]


def _reference(df: DataFrame, number: int, e: Expectation, references: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows without a parent, over the whole of both tables."""
    _, parent, key = REFERENCES[e.type]
    keys = orphan_keys(df, e.column, references[parent], key)
    sums = keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("_n"),
        F.coalesce(F.sum(F.when(F.col(e.column).isNull(), F.col("n"))), F.lit(0)).alias("_nulls"),
        F.coalesce(F.sum(F.when(~F.col("found"), F.col("n"))), F.lit(0)).alias("_bad"),
    )
    return sums.select(F.inline(F.array(outcome(number, F.col("_n"), F.col("_nulls"), F.col("_bad")))))


def _numbered(suite: Suite, sampled: bool) -> list[tuple[int, Expectation]]:
    """The checks of a suite with their numbers; a sample says nothing of the number of rows."""
    return [(i, e) for i, e in enumerate(suite.expectations, 1) if not (sampled and e.type in TABLE_CHECKS)]


def _compares_tables(df: DataFrame, e: Expectation) -> bool:
    return e.type in REFERENCES and e.column in df.columns


def observe_suite(df: DataFrame, suite: Suite, by: Sequence[str] = (), sampled: bool = False,
                  nulls_of: Sequence[str] = (), latest_of: str | None = None) -> DataFrame:
    """``observe`` for the checks of a suite, but those that compare tables."""
    checks = [(i, e) for i, e in _numbered(suite, sampled) if not _compares_tables(df, e)]
    return observe(df, checks, by, nulls_of, latest_of)


def validate(df: DataFrame, suite: Suite, by: Sequence[str] = (),
             references: Mapping[str, DataFrame] | None = None, sampled: bool = False,
             observed: DataFrame | None = None) -> DataFrame:
    """One row per check, with its counts and verdict.

    With ``by`` every batch of the table is validated on its own, in the same scan.
    Row-count checks are left out for a sample.  A check of a column that does not exist
    fails.  ``observed`` is what ``observe_suite`` found, so that the table is not read again.
    """
    by = list(by)
    numbered = _numbered(suite, sampled)
    across = [(i, e) for i, e in numbered if _compares_tables(df, e)]
    if across and by:
        raise ValueError(f"{across[0][1].type} compares whole tables and cannot run by batch")
    parts = []
    if len(across) < len(numbered):
        found = observe_suite(df, suite, by, sampled) if observed is None else observed
        parts.append(found.select(*by, F.inline("outcomes")))
    parts += [_reference(df, i, e, references or {}) for i, e in across]
    outcomes = reduce(DataFrame.unionByName, parts)

    meaning = {i: e for i, e in numbered}

    def per_check(value) -> Column:
        """A property of the expectation, looked up by check number."""
        return F.element_at(F.create_map(*[F.lit(x) for i, e in meaning.items() for x in (i, value(e))]),
                            F.col("check_no"))

    base = F.when(per_check(lambda e: e.type in OVER_ALL_ROWS), F.col("element_count")).otherwise(
        F.col("element_count") - F.col("missing_count"))
    good_share = safe_divide(base - F.col("unexpected_count"), base)
    verdict = F.coalesce("passed", good_share >= per_check(lambda e: e.mostly), F.lit(True))
    percent = F.when(F.col("unexpected_count").isNotNull(),
                     F.coalesce(safe_divide(F.col("unexpected_count") * 100, base), F.lit(0.0)))
    return outcomes.select(
        *by,
        F.lit(suite.name).alias("suite_name"), F.lit(suite.dataset).alias("dataset"),
        F.col("check_no").cast("bigint").alias("check_no"),
        per_check(lambda e: e.type).alias("expectation_type"),
        F.nullif(per_check(lambda e: e.column or ""), F.lit("")).alias("column"),
        verdict.alias("success"),
        "element_count", "missing_count", "unexpected_count",
        round_half_away(percent, 4).alias("unexpected_percent"),
    )


def unexpected_values(df: DataFrame, expectation: Expectation, limit: int | None = EXAMPLES,
                      references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The first few offending values, in value order; all of them, in no order, with limit None."""
    column = expectation.column
    if expectation.type in REFERENCES:
        _, parent, key = REFERENCES[expectation.type]
        bad = orphan_keys(df, column, (references or {})[parent], key).filter(~F.col("found")).select(column, "n")
    elif expectation.type == UNIQUE:
        bad = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    else:
        bad = df.filter(expectation.unexpected()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return bad if limit is None else bad.orderBy(column).limit(limit)


def sample_rows(df: DataFrame, n: int = 10_000, seed: int = 42) -> DataFrame:
    """A sample of n rows, each row as likely as any other; all rows if there are no more.

    Copies of a row are numbered, and each row draws a hash of the seed, its values and its number; the
    n least draws are taken.  So the sample is the same for any partitioning and on any engine, and
    identical rows are taken as often as their share of the table.  A bound on the draw that
    leaves over n candidates, far beyond doubt, keeps what travels to one place near n.
    """
    names = df.columns
    numbered = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies")).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_copies")
    values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in (*names, "_copy")]
    drawn = numbered.withColumn("_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), *values)))
    share = (n + 8 * n**0.5 + 64) / max(1, df.count())
    bound = f"{min(2**32 - 1, int(share * 2**32)):08x}"
    return drawn.where(F.substring("_draw", 1, 8) <= bound).orderBy("_draw", *names, "_copy").limit(n).select(*names)


def suite_statistics(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Evaluated, passed and failed checks of each suite (and batch)."""
    passed = count_where(F.col("success"))
    return results.groupBy(*by, "suite_name", "dataset").agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        count_where(~F.col("success")).alias("unsuccessful_expectations"),
        round_half_away(safe_divide(passed * 100, F.count(F.lit(1))), 1).alias("success_percent"),
        F.min("success").alias("success"),
    )


def checkpoint(suites: Sequence[Suite], datasets: Mapping[str, DataFrame], sampled: bool = False) -> DataFrame:
    """Results of several suites over the named datasets."""
    return reduce(DataFrame.unionByName, [
        validate(datasets[s.dataset], s, references=datasets, sampled=sampled) for s in suites
    ])


def totals(results: DataFrame) -> DataFrame:
    """Checks run, passed and failed over all suites, and whether all passed."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        count_where(F.col("success")).alias("passed"),
        count_where(~F.col("success")).alias("failed"),
        F.min("success").alias("all_passed"),
    )
