"""Named dimensions and measures over a table, turned into one grouped aggregation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import exact_sum, safe_divide

_BUCKETS: dict[str, Callable[[Column], Column]] = {
    "value": lambda c: c,
    "date": lambda c: c.cast("date"),
    "week": lambda c: F.date_trunc("week", c).cast("date"),
    "month": lambda c: F.trunc(c.cast("date"), "MM"),
}


@dataclass(frozen=True)
class Dimension:
    """A column to group by, optionally re-bucketed to date, Monday week or month."""

    column: str
    bucket: str = "value"

    def expr(self) -> Column:
        return _BUCKETS[self.bucket](F.col(self.column))


@dataclass(frozen=True)
class Measure:
    """An aggregate, or a formula over other measures.

    ``aggregate`` builds the aggregate column.  A formula has ``needs`` instead: the names
    of the measures it reads after aggregation.
    """

    aggregate: Callable[[], Column] | None = None
    formula: Callable[..., Column] | None = None
    needs: tuple[str, ...] = ()

    @staticmethod
    def sum(column: str) -> Measure:
        return Measure(lambda: F.sum(column))

    @staticmethod
    def money(column: str) -> Measure:
        """Exact sum of a money column."""
        return Measure(lambda: exact_sum(column))

    @staticmethod
    def avg(column: str) -> Measure:
        """Mean of the known values of a column, from their exact sum."""
        return Measure(lambda: safe_divide(exact_sum(column), F.count(column)))

    @staticmethod
    def weighted_avg(column: str, weight: str) -> Measure:
        return Measure(lambda: safe_divide(
            exact_sum(F.col(column) * F.col(weight)), F.sum(weight)))

    @staticmethod
    def max(column: str) -> Measure:
        return Measure(lambda: F.max(column))

    @staticmethod
    def min(column: str) -> Measure:
        return Measure(lambda: F.min(column))

    @staticmethod
    def count() -> Measure:
        return Measure(lambda: F.count(F.lit(1)))

    @staticmethod
    def count_distinct(column: str) -> Measure:
        return Measure(lambda: F.countDistinct(column))

    @staticmethod
    def of(*needs: str, formula: Callable[..., Column]) -> Measure:
        return Measure(formula=formula, needs=needs)


@dataclass(frozen=True)
class RecentWindow:
    """The last n days or months of a date column, the current one included."""

    column: str
    unit: str  # day or month
    size: int

    def condition(self, as_of: dt.date | None, size: int | None = None) -> Column:
        today = F.current_date() if as_of is None else F.lit(as_of)
        day = F.col(self.column).cast("date")
        back = (size or self.size) - 1
        start = F.date_sub(today, back) if self.unit == "day" else F.add_months(F.trunc(today, "MM"), -back)
        return day.between(start, today)


@dataclass(frozen=True)
class SemanticView:
    name: str
    table: str
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Measure]
    recent: RecentWindow | None = None  # applied to every query unless the query changes it
    access: tuple[str, str] | None = None  # (dimension, user attribute listing allowed values)
    window_choices: tuple[str, ...] = field(default=())

    def restrict(self, table: DataFrame, filters: Mapping[str, Sequence | Column] | None = None,
                 as_of: dt.date | None = None, window: int | str | None = None,
                 user: Mapping[str, Sequence[str]] | None = None, trusted: bool = False) -> DataFrame:
        """Rows a query may see.

        ``window`` changes the size of the recent window, or lifts it with ``"all"``; a view
        that names its choices takes no other.  ``filters`` maps a dimension to allowed
        values (none listed: all) or to a condition.  ``user`` are the attributes of the
        user, without which a view with an access rule refuses, unless the caller is
        ``trusted``.
        """
        if self.window_choices and window is not None and str(window) not in self.window_choices:
            raise ValueError(f"window must be one of {self.window_choices}")
        if self.recent and window != "all":
            table = table.filter(self.recent.condition(as_of, None if window is None else int(window)))
        if self.access and not trusted:
            dimension, attribute = self.access
            if user is None or attribute not in user:
                raise PermissionError(f"{self.name} needs user attribute {attribute}")
            table = table.filter(self.dimensions[dimension].expr().isin(list(user[attribute])))
        for name, wanted in (filters or {}).items():
            if isinstance(wanted, Column):
                table = table.filter(wanted)
            elif wanted:
                table = table.filter(self.dimensions[name].expr().isin(list(wanted)))
        return table

    def _base_measures(self, names: Sequence[str]) -> list[str]:
        """Aggregates behind the named measures, each once."""
        found: dict[str, None] = {}

        def visit(name: str) -> None:
            measure = self.measures[name]
            if measure.aggregate is not None:
                found[name] = None
            for need in measure.needs:
                visit(need)

        for name in names:
            visit(name)
        return list(found)

    def _value(self, name: str) -> Column:
        measure = self.measures[name]
        if measure.aggregate is not None:
            return F.col(name)
        return measure.formula(*[self._value(n) for n in measure.needs])

    def query(self, table: DataFrame, dimensions: Sequence[str] = (), measures: Sequence[str] = (),
              sort: Sequence[str] = (), limit: int | None = None, **restrictions) -> DataFrame:
        """Group by the dimensions and compute the measures.

        ``sort`` entries are ``"name"`` or ``"name desc"``; other options are those of
        ``restrict``, whose conditions reach the scan of the table.
        """
        rows = self.restrict(table, **restrictions)
        grouped = rows.groupBy(*[self.dimensions[d].expr().alias(d) for d in dimensions])
        base = self._base_measures(measures)
        if base:
            totals = grouped.agg(*[self.measures[m].aggregate().alias(m) for m in base])
        else:
            totals = rows.select(*[self.dimensions[d].expr().alias(d) for d in dimensions]).distinct()
        out = totals.select(*dimensions, *[self._value(m).alias(m) for m in measures])
        if sort:
            out = out.orderBy(*[
                F.col(s.split()[0]).desc() if s.endswith(" desc") else F.col(s.split()[0]).asc() for s in sort
            ])
        return out if limit is None else out.limit(limit)
