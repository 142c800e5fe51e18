"""What one scan of a table tells: the counts of a suite's checks, the nulls of every column, the latest instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.quality.expectations import EXISTS, REFERENCES, ROWS_ABOVE, TABLE_CHECKS, UNIQUE, Expectation


def _long(value: Column | None) -> Column:
    return (F.lit(None) if value is None else value).cast("bigint")


def outcome(number: int, elements: Column | None = None, missing: Column | None = None,
            unexpected: Column | None = None, passed: Column | None = None) -> Column:
    """The counts of one check, as a struct.  ``passed`` overrides the share of good values."""
    return F.struct(F.lit(number).alias("check_no"), _long(elements).alias("element_count"),
                    _long(missing).alias("missing_count"), _long(unexpected).alias("unexpected_count"),
                    (F.lit(None) if passed is None else passed).cast("boolean").alias("passed"))


def _rows_in_range(e: Expectation, n: Column) -> Column:
    if e.type == ROWS_ABOVE:
        return n > F.lit(e.args["value"])
    low, high = e.args.get("min_value"), e.args.get("max_value")
    passed = F.lit(True)
    if low is not None:
        passed = passed & (n >= low)
    if high is not None:
        passed = passed & (n <= high)
    return passed


def _patterns_and_values(df: DataFrame, conditions: list[Column], keys: list[str], by: list[str], latest: Column):
    """Copies of each pattern and of each value of the keys, which of these rows are patterns, and which values of each key."""
    letters = [F.when(c, "x").otherwise("-") for c in conditions]
    marked = df.withColumn("_pattern", F.concat(*letters) if letters else F.lit(""))
    grouped = [*by, "_pattern", *[k for k in keys if k not in by]]
    sets = [list(dict.fromkeys([*by, k])) for k in ("_pattern", *keys)]
    copies = marked.groupingSets(sets, *grouped).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_copies"), latest.alias("_latest"))
    # The id has a bit per column, the first one highest, which is zero where the column takes part in the set.
    ids = [sum(2 ** (len(grouped) - 1 - p) for p, c in enumerate(grouped) if c not in s) for s in sets]
    in_patterns, *value_sets = [F.col("_set") == i for i in ids]
    return copies, in_patterns, value_sets


def observe(df: DataFrame, checks: Sequence[tuple[int, Expectation]] = (), by: Sequence[str] = (),
            nulls_of: Sequence[str] = (), latest_of: str | None = None) -> DataFrame:
    """One row per batch: (*by, row_count, outcomes, null_counts, latest_data_timestamp), from one scan.

    Counts of rows are plain sums.  Where values must be unique, a row counts towards its *pattern*, a letter for
    each condition it may break, and towards each such value: grouping sets of one aggregation, so each task
    reduces its rows to its patterns and values before the shuffle.  Patterns are few; a second aggregation reads
    the counts off them.  A value with very many copies is one row per task.  ``outcomes`` has an entry per check, ``null_counts`` one per
    column of ``nulls_of``; without rows a table without batches gives counts of zero.
    """
    by = list(by)
    keys = list(dict.fromkeys(e.column for _, e in checks if e.type == UNIQUE and e.column in df.columns))
    counted = [(i, e) for i, e in checks
               if e.type not in (*TABLE_CHECKS, EXISTS, UNIQUE, *REFERENCES) and e.column in df.columns]
    with_nulls = list(dict.fromkeys([*nulls_of, *(e.column for _, e in counted)]))

    conditions = [F.col(c).isNull() for c in with_nulls] + [e.unexpected() for _, e in counted]
    latest = (F.lit(None) if latest_of is None else F.max(latest_of)).cast("timestamp")
    if keys:
        rows, in_patterns, value_sets = _patterns_and_values(df, conditions, keys, by, latest)
        n, latest = F.col("_copies"), F.max(F.when(in_patterns, F.col("_latest")))
        broken = [in_patterns & (F.substring("_pattern", j, 1) == "x") for j in range(1, len(conditions) + 1)]
    else:
        rows, in_patterns, value_sets = df, F.lit(True), []
        n, broken = F.lit(1), conditions

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    sums = [total(in_patterns).alias("_n"), latest.alias("_latest")]
    sums += [total(condition).alias(f"_is_{j}") for j, condition in enumerate(broken, 1)]
    for k, (key, here) in enumerate(zip(keys, value_sets)):
        sums += [total(here & F.col(key).isNull()).alias(f"_blank_{k}"),
                 total(here & F.col(key).isNotNull() & (n > 1)).alias(f"_repeated_{k}")]
    totals = rows.groupBy(*by).agg(*sums)

    nulls = {c: F.col(f"_is_{j}") for j, c in enumerate(with_nulls, 1)}
    bad = {i: F.col(f"_is_{j}") for j, (i, _) in enumerate(counted, len(with_nulls) + 1)}
    outcomes = []
    for i, e in checks:
        if e.type in TABLE_CHECKS:
            outcomes.append(outcome(i, elements=F.col("_n"), passed=_rows_in_range(e, F.col("_n"))))
        elif e.type == EXISTS:
            outcomes.append(outcome(i, passed=F.lit(e.column in df.columns)))
        elif e.column not in df.columns:
            outcomes.append(outcome(i, passed=F.lit(False)))
        elif e.type == UNIQUE:
            k = keys.index(e.column)
            outcomes.append(outcome(i, F.col("_n"), F.col(f"_blank_{k}"), F.col(f"_repeated_{k}")))
        else:
            outcomes.append(outcome(i, F.col("_n"), nulls[e.column], bad[i]))
    null_counts = [F.struct(F.lit(c).alias("column"), nulls[c].alias("null_count")) for c in nulls_of]
    no_outcomes = F.expr("array()").cast("array<struct<check_no:int,element_count:bigint,missing_count:bigint,"
                                         "unexpected_count:bigint,passed:boolean>>")
    no_nulls = F.expr("array()").cast("array<struct<column:string,null_count:bigint>>")
    return totals.select(
        *by, F.col("_n").alias("row_count"), (F.array(*outcomes) if outcomes else no_outcomes).alias("outcomes"),
        (F.array(*null_counts) if null_counts else no_nulls).alias("null_counts"),
        F.col("_latest").alias("latest_data_timestamp"))
