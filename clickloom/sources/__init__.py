from clickloom.sources.csv import BadRecords, Load, load_csv, read_raw_csv
from clickloom.sources.logs import append_metrics, append_runs, drop_old_runs, read_metrics, read_runs
from clickloom.sources.tables import Warehouse, between, write_table

__all__ = [
    "BadRecords",
    "Load",
    "Warehouse",
    "append_metrics",
    "append_runs",
    "between",
    "drop_old_runs",
    "load_csv",
    "read_metrics",
    "read_raw_csv",
    "read_runs",
    "write_table",
]
