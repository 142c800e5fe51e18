"""Column expressions shared by every layer.

All of them are built-in Spark expressions, so they stay inside whole-stage code
generation; none is a UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Doubles at or beyond 2**53 carry no fractional digits that rounding could remove.
_EXACT_DOUBLE_LIMIT = float(2**53)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str, on_zero: float | None = None) -> Column:
    """Double division that yields NULL for a zero or NULL operand instead of raising.

    ``on_zero`` replaces that NULL, for callers who want the zero-filling variant.
    """
    quotient = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return quotient if on_zero is None else F.coalesce(quotient, F.lit(float(on_zero)))


def round_half_away(x: Column | str, digits: int = 0) -> Column:
    """Round a double half away from zero using only double arithmetic.

    ``F.round`` goes through a decimal object per value; this stays primitive and gives
    the same bits as any other engine evaluating the same expression.
    """
    x = _col(x).cast("double")
    scale = float(10**digits)
    scaled = F.abs(x) * scale
    size = F.floor(scaled + 0.5).cast("double") / scale
    return F.when(scaled >= _EXACT_DOUBLE_LIMIT, x).when(x < 0, F.lit(0.0) - size).otherwise(size)


def micros_to_euros(micros: Column | str, digits: int = 4) -> Column:
    """Micro-currency integer to euros, rounded half away from zero in integer arithmetic."""
    m = _col(micros).cast("bigint")
    step = 10 ** (6 - digits)
    shifted = F.abs(m) + F.lit(step // 2)
    kept = shifted - shifted % F.lit(step)
    euros = kept.cast("double") / F.lit(1e6)
    return F.when(m < 0, F.lit(0.0) - euros).otherwise(euros)


# A double is split into its whole part and three limbs of its fraction, 22 bits each: integers whose sums are exact.
LIMB = 2**22
_SCALE = LIMB**3


def limbs(amount: Column | str) -> list[Column]:
    """Whole part and three limbs of a double, with its sign: amount = w + (a + (b + c / LIMB) / LIMB) / LIMB.

    Every step is exact in doubles.  Digits below 2**-66 are cut off; a double of 2**-14 or more has none.
    """
    x = _col(amount).cast("double")
    sign = F.when(x < 0, F.lit(-1).cast("bigint")).otherwise(F.lit(1).cast("bigint"))
    parts, rest = [], F.abs(x)
    for _ in range(4):
        whole = F.floor(rest)
        parts.append(sign * whole)
        rest = (rest - whole.cast("double")) * float(LIMB)
    return parts


def units_of(sums: Sequence[Column]) -> Column:
    """Sums of the four limbs as one whole number of 2**-66 units, in a decimal of 38 digits."""
    total = None
    for power, part in zip((3, 2, 1, 0), sums, strict=True):
        term = (part.cast("decimal(38,0)") * F.lit(Decimal(LIMB**power))).cast("decimal(38,0)")
        total = term if total is None else (total + term).cast("decimal(38,0)")
    return total


def exact_units(amount: Column | str, where: Column | None = None) -> Column:
    """Aggregate: the exact sum of a double in 2**-66 units, of the rows that satisfy ``where``.

    Four 64-bit sums, so it stays a hash aggregate; they hold 2**41 rows of a group, and totals up to 2**60.  Results
    of parts can be added up.  ANSI mode raises on overflow.
    """
    return units_of([F.sum(p if where is None else F.when(where, p).otherwise(F.lit(0))) for p in limbs(amount)])


def units_to_double(units: Column | str) -> Column:
    """The double next to a sum in 2**-66 units; its whole part and its fraction are rounded together, once."""
    u = _col(units).cast("decimal(38,0)")
    size = F.abs(u)
    fraction = F.pmod(size, F.lit(Decimal(_SCALE)))
    whole = F.call_function("div", size - fraction, F.lit(Decimal(_SCALE)))
    low = F.pmod(fraction, F.lit(Decimal(LIMB)))
    high = F.call_function("div", fraction - low, F.lit(Decimal(LIMB)))
    value = whole.cast("double") + (high.cast("double") / float(LIMB**2) + low.cast("double") / float(_SCALE))
    return value * F.when(u < 0, -1.0).otherwise(1.0)


def exact_sum(amount: Column | str, where: Column | None = None) -> Column:
    """Sum of a double column without rounding any amount; it does not depend on row order or partitioning."""
    return units_to_double(exact_units(amount, where))


def count_where(condition: Column) -> Column:
    """Count of rows for which the condition is true."""
    return F.count_if(condition)


def strip_space(text: Column | str) -> Column:
    """Trim every Unicode white-space character from both ends."""
    return F.btrim(_col(text), F.lit(WHITE_SPACE))


def normalize_label(text: Column | str, case: str = "upper") -> Column:
    """Trimmed label in one case (``upper``, ``lower`` or ``keep``)."""
    stripped = strip_space(text)
    if case == "upper":
        return F.upper(stripped)
    if case == "lower":
        return F.lower(stripped)
    if case == "keep":
        return stripped
    raise ValueError(f"unknown case {case!r}")


def week_start(ts: Column | str) -> Column:
    """Monday 00:00 of the week, as a timestamp."""
    return F.date_trunc("week", _col(ts))


def month_start(ts: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(_col(ts)), "MM")


def elapsed(unit: str, start: Column | str, end: Column | str) -> Column:
    """Whole elapsed units from start to end, truncated toward zero.

    Days are 24-hour spans, not calendar-date differences.
    """
    return F.timestamp_diff(unit.upper(), _col(start), _col(end))


def clamp(x: Column, low: float, high: float) -> Column:
    """Keep x within [low, high]; NULL stays NULL (``least``/``greatest`` would skip it)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def band(x: Column | str, floors: Sequence[tuple[float, str]], otherwise: str, ceilings: bool = False,
         strict: bool = False) -> Column:
    """Label of the first bound that x meets, in the given order; else ``otherwise``.

    Bounds are lower bounds (``>=``) by default, upper bounds (``<=``) with ``ceilings``;
    ``strict`` excludes the bound itself.  NULL gets ``otherwise``.
    """
    x = _col(x)
    label = None
    for bound, name in floors:
        limit = F.lit(bound)
        if ceilings:
            test = x < limit if strict else x <= limit
        else:
            test = x > limit if strict else x >= limit
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.otherwise(F.lit(otherwise))


# The tier bounds and names.  Neighbouring ranges share their bound and the
# first match wins, so 7000 is medium and 200 is medium.
BUDGET_SMALL_BELOW = 2000.0
BUDGET_RANGES = [(2000.0, 7000.0, "medium"), (7000.0, 10000.0, "large")]
REVENUE_LOW_BELOW = 50.0
REVENUE_RANGES = [(50.0, 200.0, "medium"), (200.0, 500.0, "high")]


def _ranged(label: Column, x: Column, ranges: Sequence[tuple[float, float, str]]) -> Column:
    for low, high, name in ranges:
        label = label.when(x.between(low, high), name)
    return label


def budget_tier(budget: Column | str) -> Column:
    x = _col(budget)
    return _ranged(F.when(x < BUDGET_SMALL_BELOW, "small"), x, BUDGET_RANGES).otherwise("enterprise")


def revenue_tier(revenue: Column | str) -> Column:
    x = _col(revenue)
    start = F.when(x == 0, "no_value").when(x < REVENUE_LOW_BELOW, "low")
    return _ranged(start, x, REVENUE_RANGES).otherwise("premium")


# The group of each normalised channel, and the display name of each type.
CHANNEL_GROUPS = {
    "GOOGLE_ADS": "Paid Search",
    "META_ADS": "Paid Social",
    "TIKTOK_ADS": "Paid Social",
    "LINKEDIN_ADS": "Paid Social",
    "EMAIL": "Owned",
    "SEO": "Organic",
}
CONVERSION_LABELS = {"purchase": "Purchase", "signup": "Signup", "lead": "Lead"}


def _lookup(key: Column, mapping: dict[str, str], default: str) -> Column:
    label = None
    for value, name in mapping.items():
        test = key == F.lit(value)
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.otherwise(F.lit(default))


def channel_group(channel: Column | str) -> Column:
    return _lookup(_col(channel), CHANNEL_GROUPS, "Other")


def conversion_label(kind: Column | str) -> Column:
    return _lookup(_col(kind), CONVERSION_LABELS, "Other")
