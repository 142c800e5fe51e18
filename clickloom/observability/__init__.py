from clickloom.observability.metrics import (
    batch_schemas,
    completeness,
    evaluate_nulls,
    evaluate_schema,
    evaluate_volume,
    freshness_metric,
    health_summary,
    latest_timestamp,
    metric_records,
    null_rates,
    rates_of,
    row_counts,
    schema_observation,
    volume_anomalies,
)
from clickloom.observability.runs import (
    failure_details,
    get_runs,
    latest_by_suite,
    pass_rate_target,
    pass_rate_trend,
    run_records,
)
from clickloom.observability.tracker import QualityTracker

__all__ = [
    "QualityTracker",
    "batch_schemas",
    "completeness",
    "evaluate_nulls",
    "evaluate_schema",
    "evaluate_volume",
    "failure_details",
    "freshness_metric",
    "get_runs",
    "health_summary",
    "latest_by_suite",
    "latest_timestamp",
    "metric_records",
    "null_rates",
    "pass_rate_target",
    "pass_rate_trend",
    "rates_of",
    "row_counts",
    "run_records",
    "schema_observation",
    "volume_anomalies",
]
