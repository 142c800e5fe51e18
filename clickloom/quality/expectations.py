"""Declared checks on a table.

An expectation is data: a type, a column and arguments.  ``unexpected`` turns it into the
condition of a bad value, which is all the validator needs.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from types import SimpleNamespace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names by which suites refer to checks.
ROWS_BETWEEN = "expect_table_row_count_to_be_between"
ROWS_ABOVE = "expect_table_row_count_to_be_greater_than"
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
MATCHES = "expect_column_values_to_match_regex"
POSITIVE = "expect_cost_is_positive"
CLICKS_HAVE_IMPRESSIONS = "expect_clicks_reference_valid_impressions"
CONVERSIONS_HAVE_CLICKS = "expect_conversions_reference_valid_clicks"

TABLE_CHECKS = (ROWS_BETWEEN, ROWS_ABOVE)
# References: type -> (default child column, parent dataset, parent key).
REFERENCES = {
    CLICKS_HAVE_IMPRESSIONS: ("impression_id", "raw_ad_impressions", "impression_id"),
    CONVERSIONS_HAVE_CLICKS: ("click_id", "raw_clicks", "click_id"),
}
# Checks whose percentages are taken over all rows rather than over known values.
OVER_ALL_ROWS = (NOT_NULL, POSITIVE, *REFERENCES)


@dataclass(frozen=True)
class Expectation:
    type: str
    column: str | None = None
    args: dict[str, Any] = field(default_factory=dict)

    @property
    def mostly(self) -> float:
        """Share of good values at which the check passes."""
        return float(self.args.get("mostly", 1.0))

    @property
    def kwargs(self) -> dict[str, str]:
        """Arguments as text, for run records."""
        named = {"column": self.column, **self.args}
        return {k: v if isinstance(v, str) else json.dumps(v) for k, v in named.items() if v is not None}

    def unexpected(self) -> Column:
        """True for a bad value of the column."""
        value = F.col(self.column)
        if self.type == NOT_NULL:
            return value.isNull()
        if self.type == IN_SET:
            return ~value.isin(list(self.args["value_set"]))
        if self.type == MATCHES:
            return ~value.rlike(self.args["regex"])
        if self.type == POSITIVE:
            return value <= 0
        if self.type == BETWEEN:
            low, high = self.args.get("min_value"), self.args.get("max_value")
            bad = F.lit(False)
            if low is not None:
                bad = bad | (value < low)
            if high is not None:
                bad = bad | (value > high)
            return bad
        raise ValueError(f"{self.type} has no row condition")


def _one(kind: str):
    return lambda column, **args: Expectation(kind, column, args)


def _each(kind: str):
    return lambda *columns: [Expectation(kind, c) for c in columns]


check = SimpleNamespace(
    rows_between=lambda low=None, high=None: Expectation(ROWS_BETWEEN, None, {"min_value": low, "max_value": high}),
    rows_above=lambda value: Expectation(ROWS_ABOVE, None, {"value": value}),
    exist=_each(EXISTS),
    not_null=_each(NOT_NULL),
    unique=_one(UNIQUE),
    in_set=lambda column, values: Expectation(IN_SET, column, {"value_set": list(values)}),
    between=lambda column, low=None, high=None, mostly=1.0: Expectation(
        BETWEEN, column, {"min_value": low, "max_value": high, "mostly": mostly}),
    matches=lambda column, regex: Expectation(MATCHES, column, {"regex": regex}),
    positive=_one(POSITIVE),
    references=lambda kind: Expectation(kind, REFERENCES[kind][0]),
)


@dataclass(frozen=True)
class Suite:
    name: str
    dataset: str
    expectations: tuple[Expectation, ...]

    @staticmethod
    def from_json(text: str, dataset: str) -> Suite:
        """A suite written as JSON: a name and a list of types with keyword arguments."""
        body = json.loads(text)
        checks = []
        for entry in body["expectations"]:
            args = dict(entry.get("kwargs", {}))
            checks.append(Expectation(entry["expectation_type"], args.pop("column", None), args))
        return Suite(body["expectation_suite_name"], dataset, tuple(checks))


def suite(name: str, dataset: str, *parts: Expectation | Sequence[Expectation]) -> Suite:
    flat: list[Expectation] = []
    for part in parts:
        flat.extend([part] if isinstance(part, Expectation) else part)
    return Suite(name, dataset, tuple(flat))
