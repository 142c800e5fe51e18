from clickloom.quality.expectations import Expectation, Suite, check
from clickloom.quality.suites import CHECKPOINTS, SUITES, integrity_suites
from clickloom.quality.validate import (
    checkpoint,
    observe_suite,
    sample_rows,
    suite_statistics,
    totals,
    unexpected_values,
    validate,
)

__all__ = [
    "CHECKPOINTS",
    "SUITES",
    "Expectation",
    "Suite",
    "check",
    "checkpoint",
    "integrity_suites",
    "observe_suite",
    "sample_rows",
    "suite_statistics",
    "totals",
    "unexpected_values",
    "validate",
]
