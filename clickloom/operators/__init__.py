from clickloom.operators.asof import asof_join
from clickloom.operators.dedup import dedup_latest, dedup_latest_rare, first_by, pick_per_group
from clickloom.operators.enrich import hot_keys, orphan_keys, skew_safe_left_join
from clickloom.operators.running import positions, running_by_time

__all__ = [
    "asof_join",
    "dedup_latest",
    "dedup_latest_rare",
    "first_by",
    "hot_keys",
    "orphan_keys",
    "pick_per_group",
    "positions",
    "running_by_time",
    "skew_safe_left_join",
]
