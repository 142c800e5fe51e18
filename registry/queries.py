"""Every operator as a query over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import fixtures
from clickloom.operators import asof_join, dedup_latest, hot_keys
from clickloom.functions import exact_sum
from clickloom.observability import (
    QualityTracker,
    batch_schemas,
    completeness,
    evaluate_schema,
    evaluate_nulls,
    evaluate_volume,
    failure_details,
    freshness_metric,
    get_runs,
    health_summary,
    latest_by_suite,
    latest_timestamp,
    metric_records,
    null_rates,
    pass_rate_target,
    pass_rate_trend,
    run_records,
    volume_anomalies,
)
from clickloom.plans import attribution, campaigns, marts, staging
from clickloom.plans.build import Build
from clickloom.quality import (
    CHECKPOINTS,
    SUITES,
    check,
    checkpoint,
    integrity_suites,
    sample_rows,
    suite_statistics,
    totals,
    unexpected_values,
    validate,
)
from clickloom.quality.expectations import CLICKS_HAVE_IMPRESSIONS, CONVERSIONS_HAVE_CLICKS, suite
from clickloom.schemas import TableSpec
from clickloom.session import scratch_path, write_down
from clickloom.sources import (
    Warehouse,
    append_metrics,
    append_runs,
    between,
    drop_old_runs,
    load_csv,
    read_metrics,
    read_raw_csv,
    read_runs,
    write_table,
)
from clickloom.semantic import CHANNEL_ROI, CUSTOMER_ACQUISITION, MARKETING_DASHBOARD, run_tile, tiles, with_ratings

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Show dates and timestamps as ISO text, so that any engine's output compares equal."""
    timely = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, timely) else F.col(f.name)
        for f in df.schema.fields
    ])


class Tables:
    """The tables of the warehouse over one data directory, composed lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.raw = fixtures.Feeds(spark, sf_dir)

    @cached_property
    def impressions(self) -> DataFrame:
        return staging.stg_ad_impressions(self.raw.impressions)

    @cached_property
    def campaigns(self) -> DataFrame:
        return staging.stg_campaigns(self.raw.campaigns)

    @cached_property
    def clean_clicks(self) -> DataFrame:
        return staging.clean_clicks(self.raw.clicks)

    @cached_property
    def clicks(self) -> DataFrame:
        return staging.stg_clicks(self.raw.clicks, self.raw.impressions)

    @cached_property
    def clean_conversions(self) -> DataFrame:
        return staging.clean_conversions(self.raw.conversions)

    @cached_property
    def conversions(self) -> DataFrame:
        return staging.stg_conversions(self.raw.conversions, self.clean_clicks)

    def performance(self, grain: str = "impression_channel") -> DataFrame:
        # Campaign totals read no column that the enrichment joins add.
        return campaigns.int_campaign_performance(
            self.campaigns, self.impressions, self.clean_clicks, self.clean_conversions, grain)

    def dashboard(self, **options) -> DataFrame:
        return marts.rpt_marketing_dashboard(self.impressions, self.clean_clicks, self.conversions, **options)

    @cached_property
    def hot_customers(self) -> DataFrame:
        return hot_keys(self.raw.conversions, ["customer_id"])

    @cached_property
    def channel_roi(self) -> DataFrame:
        return marts.rpt_channel_roi(self.performance())

    @cached_property
    def acquisition(self) -> DataFrame:
        return marts.rpt_customer_acquisition(self.conversions, self.performance(), self.hot_customers)


def _attribution(build: Callable[..., DataFrame], mode: str) -> Callable[[Tables], DataFrame]:
    # Attribution reads no column that the clicks get from their impressions.
    return lambda t: build(t.clean_conversions, t.clean_clicks, mode)


def _linear(mode: str) -> Callable[[Tables], DataFrame]:
    return _attribution(attribution.linear_attribution, mode)


def _credit(mode: str) -> Callable[[Tables], DataFrame]:
    return _attribution(attribution.linear_credit, mode)


def _last_click(t: Tables) -> DataFrame:
    """The click by anyone that came last before each conversion."""
    return asof_join(t.clean_conversions.select("conversion_id", "customer_id", "conversion_timestamp"),
                     t.clean_clicks.select("click_id", "channel", "platform", "click_timestamp"),
                     "conversion_timestamp", "click_timestamp", ties=["click_id"])


def _next_click(t: Tables) -> DataFrame:
    """The first click on the same campaign after each conversion, within sixty days."""
    return asof_join(t.clean_conversions.select("conversion_id", "campaign_id", "conversion_timestamp"),
                     t.clean_clicks.select("campaign_id", F.col("click_id").alias("next_click_id"), "click_timestamp"),
                     "conversion_timestamp", "click_timestamp", by=["campaign_id"], ties=["next_click_id"], direction="forward", strict=True,
                     within="60 days")


def _customers_by_sketch(t: Tables) -> DataFrame:
    """Distinct customers by campaign over half a year and by month over all campaigns: exact, and whether the merged sketches are near."""
    kept = write_down(campaigns.customer_sketches(t.clean_conversions))
    start, end = dt.date(1996, 1, 1), dt.date(1996, 6, 30)
    month = F.trunc("conversion_date", "MM").cast("string")
    spans = [
        (campaigns.estimated_customers(kept, ["campaign_id"], start, end),
         t.clean_conversions.filter(F.col("conversion_date").between(F.lit(start), F.lit(end))), "campaign_id"),
        (campaigns.estimated_customers(kept.withColumn("month", month), ["month"]), t.clean_conversions.withColumn("month", month), "month"),
    ]
    found = []
    for estimate, rows, key in spans:
        exact = rows.groupBy(key).agg(F.countDistinct("customer_id").alias("unique_customers"))
        off = F.abs(F.col("estimated_customers") - F.col("unique_customers"))
        found.append(exact.join(estimate, key, "left").select(
            F.lit(key).alias("span"), F.col(key).alias("value"), "unique_customers",
            F.coalesce(off <= F.col("unique_customers") * campaigns.sketch_error(), F.lit(False)).alias("within_error")))
    return reduce(DataFrame.unionByName, found)


def _summary(mode: str) -> Callable[[Tables], DataFrame]:
    return _attribution(attribution.attribution_summary, mode)


# The windows of the reports end here, so that a run gives the same rows on any day.
AS_OF = dt.date(2001, 6, 30)


def _tile(name: str, table: str) -> Callable[[Tables], DataFrame]:
    tables = {"dashboard": lambda t: t.dashboard(), "roi": lambda t: t.channel_roi,
              "acquisition": lambda t: t.acquisition}
    return lambda t: run_tile(name, tables[table](t), **({} if table == "roi" else {"window": "all", "trusted": True}))


def _ratings(t: Tables) -> DataFrame:
    rated = with_ratings(t.channel_roi, {"avg_roas": "roas", "roi_pct": "roi", "channel_health_score": "health",
                                         "profit_euros": "profit"})
    return rated.select("channel", "avg_roas", "roi_pct", "channel_health_score", "profit_euros",
                        *[c for c in rated.columns if c.endswith("_rating")])


def _acquisition_ratings(t: Tables) -> DataFrame:
    rated = with_ratings(t.acquisition, {"payback_period_days": "payback", "ltv_90d_to_cac_ratio": "ltv_cac",
                                         "acquisition_health": "acquisition_health"})
    return rated.select("channel", "acquisition_month", *[c for c in rated.columns if c.endswith("_rating")])


RAW_CHECKPOINT = CHECKPOINTS["raw_data_checkpoint"]


def _raw(t: Tables) -> dict[str, DataFrame]:
    return {"raw_ad_impressions": t.raw.impressions, "raw_clicks": t.raw.clicks,
            "raw_conversions": t.raw.conversions}


def _suite(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: validate(_raw(t)[SUITES[name].dataset], SUITES[name])


def _orphans(kind: str, child: str, limit: int | None = None) -> Callable[[Tables], DataFrame]:
    return lambda t: unexpected_values(_raw(t)[child], check.references(kind), limit=limit, references=_raw(t))


def _sampled(t: Tables) -> DataFrame:
    sample = sample_rows(t.raw.clicks, n=1000)
    return validate(sample, SUITES["raw_clicks_suite"], sampled=True)


# Each week of a feed is validated as the batch of one run, so the history grows with the data.
BATCH_SUITES = [
    suite("click_batch_suite", "raw_clicks", check.rows_between(20),
          check.not_null("click_id", "impression_id"), check.unique("click_id"),
          check.between("cost_micros", 0, 490_000, mostly=0.97)),
    suite("conversion_batch_suite", "raw_conversions", check.rows_between(5),
          check.not_null("conversion_id", "revenue"), check.unique("conversion_id"),
          check.between("revenue", 0, 1950)),
]
NOW = dt.datetime(2001, 6, 30, 12, 0)


def _weekly(df: DataFrame) -> DataFrame:
    return df.withColumn("batch", F.date_trunc("week", "timestamp"))


def _runs(t: Tables) -> DataFrame:
    feeds = _raw(t)
    records = [
        run_records(validate(_weekly(feeds[s.dataset]), s, by=["batch"]), s, F.col("batch"), by=["batch"])
        for s in BATCH_SUITES
    ]
    return reduce(DataFrame.unionByName, records)


def _plain(runs: DataFrame) -> DataFrame:
    return runs.drop("expectations", "metadata")


def _failures(t: Tables) -> DataFrame:
    return failure_details(_runs(t)).withColumn("unexpected", F.col("details")["unexpected_count"]).drop("details")


def _volumes(t: Tables, lag: int = 1) -> DataFrame:
    weekly = [
        _weekly(df).groupBy(F.col("batch").alias("timestamp")).agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("dataset", F.lit(name)) for name, df in _raw(t).items()
    ]
    return evaluate_volume(reduce(DataFrame.unionByName, weekly), expected_min=8, lag=lag)


def _freshness(t: Tables) -> DataFrame:
    latest = [latest_timestamp(df).withColumn("dataset", F.lit(name)) for name, df in _raw(t).items()]
    return freshness_metric(reduce(DataFrame.unionByName, latest), dt.datetime(2001, 11, 6), 1440)


def _null_rates(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [null_rates(df, name) for name, df in _raw(t).items()])


def _schemas(t: Tables) -> DataFrame:
    """The columns of every feed, day by day."""
    daily = [batch_schemas(df.withColumn("batch", F.date_trunc("day", "timestamp")), name, "batch")
             for name, df in _raw(t).items()]
    return evaluate_schema(reduce(DataFrame.unionByName, daily))


def _schema_drift(t: Tables) -> DataFrame:
    changes = [F.concat_ws(",", F.col("drift")[kind]).alias(kind) for kind in ("added", "removed", "type_changed")]
    return _schemas(t).select("dataset", "timestamp", "column_count", *changes, "status")


def _health(t: Tables) -> DataFrame:
    nulls = evaluate_nulls(_null_rates(t), F.lit(NOW))
    kinds = {"volume": _volumes(t), "freshness": _freshness(t), "null_rates": nulls, "schema": _schemas(t)}
    return health_summary(reduce(DataFrame.unionByName, [metric_records(df, k) for k, df in kinds.items()]))


def _null_records(t: Tables) -> DataFrame:
    records = evaluate_nulls(_null_rates(t), F.lit(NOW))
    return records.select("dataset", "total_rows", "threshold_pct", "status",
                          F.concat_ws(",", "flagged_columns").alias("flagged_columns"))


# Sources and sinks: what is written to the checkpoint folder must read back the same.


def _csv(df: DataFrame) -> str:
    """A folder with the rows of a frame as CSV, dates and instants as text and blanks as they are."""
    path = scratch_path(df.sparkSession)
    (portable(df).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def _built(t: Tables) -> DataFrame:
    """Rows of every table of a warehouse built from CSV files: (layer, dataset, row_count).

    The databases live in the session's catalog under a prefix of their own, their files in the checkpoint folder; both
    go when the rows are counted.
    """
    prefix = f"build_{uuid.uuid4().hex[:12]}_"
    build = Build(Warehouse(t.spark, prefix, scratch_path(t.spark), grain="month"))
    feeds = {**_raw(t), "raw_campaigns": t.raw.campaigns}
    try:
        build.run({name: _csv(feed) for name, feed in feeds.items()})
        return write_down(build.counts(raw=True).select(
            F.expr(f"substring(layer, {len(prefix) + 1})").alias("layer"), F.col("table").alias("dataset"), "row_count"))
    finally:
        build.warehouse.drop()


def _table_counts(t: Tables) -> DataFrame:
    return _built(t).filter("layer <> 'raw_marketing'").drop("layer")


def _spoiled(t: Tables, anonymous: bool = False) -> str:
    """Conversions as CSV; those with a padded type get a revenue that is no number, some lose their customer if asked."""
    spoiled = t.raw.conversions.withColumn(
        "revenue", F.when(F.col("conversion_type").startswith(" "), "n/a").otherwise(F.col("revenue").cast("string")))
    if anonymous:
        spoiled = spoiled.withColumn("customer_id", F.when(~F.col("customer_id").endswith("7"), F.col("customer_id")))
    return _csv(spoiled)


def _csv_load(t: Tables) -> DataFrame:
    return load_csv(t.spark, _spoiled(t), "raw_conversions", max_bad_share=0.1).rows


def _csv_rejects(t: Tables) -> DataFrame:
    return load_csv(t.spark, _spoiled(t, anonymous=True), "raw_conversions", max_bad_share=0.3).rejects


def _csv_strict(t: Tables) -> DataFrame:
    return read_raw_csv(t.spark, _csv(t.raw.conversions), "raw_conversions")


# Conversions laid out by month and clustered within it.
MONTHLY = TableSpec("raw", "conversions_by_month", None, "event_month", "trunc(timestamp, 'MM')",
                    ("campaign_id", "conversion_type"))


def _partitioned_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark)
    write_table(t.raw.conversions, MONTHLY, path)
    read = t.spark.read.parquet(path)
    return read.groupBy("event_month").agg(F.count(F.lit(1)).alias("conversions"), exact_sum("revenue").alias("revenue"))


def _conversions_between(t: Tables) -> DataFrame:
    """The conversions of some weeks, read from the partitions of their months."""
    path = scratch_path(t.spark)
    write_table(t.raw.conversions, MONTHLY, path)
    return between(t.spark.read.parquet(path), MONTHLY, dt.datetime(1996, 3, 11, 6), dt.datetime(1996, 5, 2)).drop("event_month")


def _run_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark)
    append_runs(_runs(t), path)
    return _plain(read_runs(t.spark, path))


def _cleanup(t: Tables) -> DataFrame:
    path = scratch_path(t.spark)
    append_runs(_runs(t), path)
    drop_old_runs(t.spark, path, NOW - dt.timedelta(days=901))
    return _plain(read_runs(t.spark, path))


def _metric_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark)
    append_metrics(metric_records(_volumes(t), "volume"), path)
    append_metrics(metric_records(_freshness(t), "freshness"), path)
    return read_metrics(t.spark, path).select(
        "timestamp", "dataset", "metric", "status", "row_count", "change_from_previous_pct", "anomaly_detected",
        "staleness_minutes")


# Two feeds as they were tracked on two days; on the first day the later rows had not come yet.
TRACKED = {dt.datetime(2001, 11, 5): dt.datetime(1997, 1, 1), dt.datetime(2001, 11, 6): None}
TRACKED_SUITES = ("raw_clicks_suite", "raw_conversions_suite")


def _tracked(t: Tables) -> QualityTracker:
    tracker = QualityTracker(t.spark, scratch_path(t.spark), scratch_path(t.spark))
    for now, before in TRACKED.items():
        for name in TRACKED_SUITES:
            feed = _raw(t)[SUITES[name].dataset]
            tracker.track(feed if before is None else feed.filter(F.col("timestamp") < F.lit(before)), SUITES[name], now=now)
    return tracker


def _track_validation(t: Tables) -> DataFrame:
    return _tracked(t).metrics.select(
        "timestamp", "dataset", "metric", "status", "row_count", "change_from_previous_pct", "anomaly_detected",
        "latest_data_timestamp", "staleness_minutes", "column_count", "total_rows",
        F.concat_ws(",", "flagged_columns").alias("flagged_columns"),
        F.aggregate(F.map_values("null_columns"), F.lit(0).cast("long"), lambda n, c: n + c["null_count"]).alias("null_count"))


def _health_bundle(t: Tables) -> DataFrame:
    """The parts of the bundle under each other: (part, name, status, amount, detail)."""
    bundle = _tracked(t).health_bundle(now=max(TRACKED))
    columns = {
        "health_summary": ["dataset", "overall", F.lit(None), F.concat_ws(" ", "freshness", "volume", "schema", "nulls")],
        "latest_runs": ["suite_name", F.col("success").cast("string"), F.col("row_count"),
                        F.concat_ws(" ", F.col("timestamp").cast("string"), "passed", "failed")],
        "pass_rate_trend": [F.col("date").cast("string"), F.lit(None), "pass_rate", F.concat_ws(" ", "passed", "total_runs")],
        "recent_failures": [F.concat_ws(" ", "suite", "expectation", "column"), F.lit("failed"),
                            F.col("details")["unexpected_count"], F.col("timestamp").cast("string")],
    }
    types = {"name": "string", "status": "string", "amount": "double", "detail": "string"}
    parts = []
    for part, values in columns.items():
        named = [(F.col(v) if isinstance(v, str) else v).cast(kind).alias(name) for v, (name, kind) in zip(values, types.items())]
        parts.append(bundle[part].select(F.lit(part).alias("part"), *named))
    return reduce(DataFrame.unionByName, parts)


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    "stg_ad_impressions": lambda t: t.impressions,
    "stg_campaigns": lambda t: t.campaigns,
    "stg_clicks": lambda t: t.clicks,
    "stg_conversions": lambda t: t.conversions,
    "dedup_latest": lambda t: dedup_latest(t.raw.conversions, ["conversion_id"], "timestamp"),
    "int_campaign_performance": lambda t: t.performance(),
    "int_campaign_performance_campaign_grain": lambda t: t.performance("campaign"),
    "unique_customers_by_sketch": _customers_by_sketch,
    "click_engagement": lambda t: campaigns.click_engagement(t.clicks),
    "rpt_marketing_dashboard": lambda t: t.dashboard(),
    "rpt_marketing_dashboard_full": lambda t: t.dashboard(keep_unmatched=True),
    "best_worst_campaign": lambda t: marts.best_worst_campaign(t.performance()),
    "rpt_channel_roi": lambda t: t.channel_roi,
    "first_conversion": lambda t: marts.first_conversions(t.conversions, t.hot_customers),
    "ltv_windows": lambda t: marts.customer_ltv(t.clean_conversions, hot=t.hot_customers),
    "rpt_customer_acquisition": lambda t: t.acquisition,
    "attribution_global_first_last": _attribution(attribution.single_touch_attribution, "global"),
    "attribution_global_linear_by_channel": _linear("global"),
    "attribution_global_linear_credit": _credit("global"),
    "attribution_global_summary": _summary("global"),
    "attribution_customer_first_last": _attribution(attribution.single_touch_attribution, "customer"),
    "attribution_customer_linear_by_channel": _linear("customer"),
    "attribution_customer_linear_credit": _credit("customer"),
    "attribution_customer_summary": _summary("customer"),
    "asof_last_click": _last_click,
    "asof_next_campaign_click": _next_click,
    "linear_credit_by_channel": _attribution(attribution.linear_credit_by, "global"),
    "linear_credit_by_channel_customer": _attribution(attribution.linear_credit_by, "customer"),
    "touch_positions_global": _attribution(attribution.touch_positions, "global"),
    "touch_positions_customer": _attribution(attribution.touch_positions, "customer"),
    "kpi_totals": lambda t: tiles.kpi_totals(t.dashboard(), window="all", trusted=True),
    "spend_by_channel": _tile("spend_by_channel", "dashboard"),
    "roas_trend": _tile("roas_trend", "dashboard"),
    "conversion_funnel": _tile("conversion_funnel", "dashboard"),
    "funnel": lambda t: tiles.funnel(t.dashboard(), window="all", trusted=True),
    "channel_roi_table": _tile("channel_roi_table", "roi"),
    "cac_by_channel_weighted": _tile("cac_by_channel", "acquisition"),
    "revenue_vs_spend": lambda t: tiles.with_mean(run_tile("revenue_vs_spend", t.channel_roi), "total_spend"),
    "new_customers_by_channel": _tile("new_customers_by_channel", "acquisition"),
    "ltv_cac_by_channel": _tile("ltv_cac_by_channel", "acquisition"),
    "dashboard_measures_by_month": lambda t: MARKETING_DASHBOARD.query(
        t.dashboard(), ["month", "platform"], list(MARKETING_DASHBOARD.measures), window="all", trusted=True),
    "acquisition_measures_by_health": lambda t: CUSTOMER_ACQUISITION.query(
        t.acquisition, ["acquisition_health"], list(CUSTOMER_ACQUISITION.measures), window="all"),
    "last_12_months_acquisition": lambda t: CUSTOMER_ACQUISITION.query(
        t.acquisition, ["acquisition_month"], ["total_new_customers", "avg_cac"], as_of=AS_OF),
    "channel_roi_measures": lambda t: CHANNEL_ROI.query(t.channel_roi, [], list(CHANNEL_ROI.measures)),
    "channel_roi_date_range": lambda t: marts.channel_roi_in_range(
        t.campaigns, t.impressions, t.clean_clicks, t.clean_conversions, "90", dt.date(1997, 6, 30)),
    "rating_bands": _ratings,
    "acquisition_rating_bands": _acquisition_ratings,
    "last_n_days_dashboard": lambda t: MARKETING_DASHBOARD.query(
        t.dashboard(), ["week", "channel"], ["total_spend", "overall_roas", "count_days"], as_of=AS_OF, trusted=True),
    "access_filtered_dashboard": lambda t: MARKETING_DASHBOARD.query(
        t.dashboard(), ["channel", "platform"], ["total_clicks", "avg_cpc"], window="all",
        user={"allowed_channels": ["EMAIL", "SEO", "META_ADS"]}, filters={"platform": ["email", "meta"]}),
    "daily_channel_trend": lambda t: tiles.daily_channel_trend(t.dashboard(), as_of=AS_OF, trusted=True),
    "week_over_week": lambda t: tiles.week_over_week(t.dashboard(), window="all", trusted=True),
    "quality_raw_impressions": _suite("raw_impressions_suite"),
    "quality_raw_clicks": _suite("raw_clicks_suite"),
    "quality_raw_conversions": _suite("raw_conversions_suite"),
    "quality_mart": lambda t: validate(t.dashboard(), SUITES["mart_dashboard_suite"]),
    "quality_integrity": lambda t: checkpoint(integrity_suites(), _raw(t)),
    "quality_suite_statistics": lambda t: suite_statistics(checkpoint(RAW_CHECKPOINT, _raw(t))),
    "quality_totals": lambda t: totals(checkpoint(RAW_CHECKPOINT, _raw(t))),
    "quality_sampled_clicks": _sampled,
    "fk_orphans_clicks": _orphans(CLICKS_HAVE_IMPRESSIONS, "raw_clicks"),
    "fk_orphans_conversions": _orphans(CONVERSIONS_HAVE_CLICKS, "raw_conversions"),
    "fk_orphan_examples": _orphans(CLICKS_HAVE_IMPRESSIONS, "raw_clicks", limit=10),
    "validation_runs": lambda t: _plain(_runs(t)),
    "recent_runs": lambda t: _plain(get_runs(_runs(t), "click_batch_suite", dt.datetime(2000, 1, 1), limit=25)),
    "pass_rate_trend": lambda t: pass_rate_target(pass_rate_trend(_runs(t), NOW, days=365)),
    "latest_by_suite": lambda t: _plain(latest_by_suite(_runs(t))),
    "failure_details": _failures,
    "volume_change": lambda t: _volumes(t),
    "volume_change_two_runs_back": lambda t: _volumes(t, lag=2),
    "volume_anomalies": lambda t: volume_anomalies(_volumes(t)),
    "freshness": _freshness,
    "schema_drift": _schema_drift,
    "null_rates": _null_rates,
    "completeness": lambda t: completeness(_null_rates(t)),
    "null_rate_records": _null_records,
    "health_summary": _health,
    "table_counts": _table_counts,
    "warehouse_build": _built,
    "csv_load": _csv_load,
    "csv_rejects": _csv_rejects,
    "csv_strict": _csv_strict,
    "conversions_between": _conversions_between,
    "partitioned_table": _partitioned_table,
    "run_log": _run_log,
    "cleanup": _cleanup,
    "metric_log": _metric_log,
    "track_validation": _track_validation,
    "health_bundle": _health_bundle,
    "duplicate_click_examples": lambda t: unexpected_values(t.raw.clicks, check.unique("click_id")),
}


def _query(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(build(Tables(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in BUILDERS.items()}
