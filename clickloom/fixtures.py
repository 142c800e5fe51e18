"""Derives the four raw feeds from order-style tables (lineitem, orders, part).

Line items play impressions; a fixed share of them become clicks and conversions.  The
feeds keep the defects the staging layer is there for: re-sent events, padded labels in
the wrong case, missing devices and countries, and dangling references.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from clickloom.schemas import CHANNELS, COUNTRIES, DEVICES, OBJECTIVES, PLATFORMS
from clickloom.session import configure


def _pick(index: str, names: Sequence[str]) -> str:
    return f"element_at(array({', '.join(repr(n) for n in names)}), cast({index} + 1 as int))"


def _padded(number: str, width: int) -> str:
    """The number with leading zeros; longer ones are left whole."""
    text = f"cast({number} as string)"
    return f"lpad({text}, greatest({width}, length({text})), '0')"


_CHANNEL_NO = "((l_partkey + l_orderkey + l_linenumber) % 6)"
_DEVICE = _pick("l_partkey % 3", DEVICES)

_EVENT = {
    "impression_id": "concat('I', l_orderkey, '-', l_linenumber)",
    "campaign_id": f"concat('C', {_padded('1 + l_partkey', 3)})",
    "channel": _pick(_CHANNEL_NO, CHANNELS),
    "platform": _pick(_CHANNEL_NO, PLATFORMS),
    "timestamp": "timestampadd(SECOND, (l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 13) % 86400, "
                 "cast(l_shipdate as timestamp))",
    "device_type": f"if(l_partkey % 11 = 0, null, {_DEVICE})",
    "country": f"if(l_suppkey % 13 = 0, null, {_pick('l_suppkey % 6', COUNTRIES)})",
    "cost_micros": "5000 + (l_partkey * 7919 + l_orderkey * 31) % 495001",
}


def _as(columns: dict[str, str]) -> list[str]:
    return [f"{expr} as {name}" for name, expr in columns.items()]


def raw_impressions(lineitem: DataFrame) -> DataFrame:
    messy = dict(
        _EVENT,
        channel=f"if(l_linenumber = 7, concat('  ', lower({_EVENT['channel']}), ' '), {_EVENT['channel']})",
        platform=f"if(l_linenumber = 7, concat(upper({_EVENT['platform']}), ' '), {_EVENT['platform']})",
    )
    return lineitem.selectExpr(*_as(messy))


def _clicked(lineitem: DataFrame) -> DataFrame:
    """Clicked line items, one per impression, with the click time."""
    kept = (
        lineitem.filter("(l_orderkey * 31 + l_linenumber * 17) % 100 < 24")
        .selectExpr(
            "*", f"{_EVENT['timestamp']} as shown",
            f"row_number() over (partition by l_orderkey, l_linenumber order by {_EVENT['timestamp']} desc, "
            "l_partkey desc, l_suppkey desc) as rn")
        .filter("rn = 1")
    )
    click = dict(_EVENT, timestamp="timestampadd(SECOND, 1 + (l_partkey * 31 + l_orderkey) % 3600, shown)")
    return kept.selectExpr(*_as(click), "l_orderkey", "l_linenumber", "l_partkey").selectExpr(
        "concat('K', impression_id) as click_id", "*")


def _resent(events: DataFrame, when: str) -> DataFrame:
    """Add a second copy (``copy`` = 1), one second earlier, of the events for which ``when`` holds."""
    copies = events.selectExpr("*", f"explode(if({when}, array(0, 1), array(0))) as copy")
    return copies.withColumnRenamed("timestamp", "sent").selectExpr(
        "*", "timestampadd(SECOND, -copy, sent) as timestamp")


def raw_clicks(lineitem: DataFrame) -> DataFrame:
    return _resent(_clicked(lineitem), "l_orderkey % 50 = 1").selectExpr(
        "click_id",
        "if(copy = 0 and l_orderkey % 97 = 0, concat('I-orphan-', l_orderkey), impression_id) as impression_id",
        "campaign_id", "channel", "platform", "timestamp", "device_type", "country", "cost_micros")


def raw_conversions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    converted = (
        _clicked(lineitem).filter("(l_orderkey * 13 + l_linenumber * 29 + l_partkey) % 100 < 29")
        .join(orders.selectExpr("o_orderkey as l_orderkey", "o_custkey"), "l_orderkey")
    )
    kinds = _pick("(l_partkey + l_orderkey) % 3", ["purchase", "lead", "signup"])
    events = converted.selectExpr(
        "concat('V', click_id) as conversion_id", "click_id", "campaign_id",
        f"concat('CUST-', {_padded('o_custkey', 5)}) as customer_id",
        "timestampadd(SECOND, 60 * (1 + (l_partkey * 17 + l_orderkey) % 1440), timestamp) as timestamp",
        f"{kinds} as kind", "l_partkey * 37 + l_orderkey * 101 as r", "l_orderkey")
    return _resent(events, "l_orderkey % 40 = 3").selectExpr(
        "conversion_id",
        "if(copy = 0 and l_orderkey % 89 = 0, concat('K-orphan-', l_orderkey), click_id) as click_id",
        "campaign_id", "customer_id", "timestamp",
        """case when copy = 1 then 1D
                when kind = 'signup' then if(r % 41 = 0, null, 0D)
                when kind = 'lead' then cast(r % 50001 as double) / 100D
                when r % 29 = 0 then 50D
                when r % 31 = 0 then 200D
                else cast(500 + r % 199501 as double) / 100D end as revenue""",
        "if(copy = 0 and r % 19 = 0, concat(' ', upper(kind)), kind) as conversion_type")


def raw_campaigns(part: DataFrame) -> DataFrame:
    """One campaign per part; starts repeat after 60 steps of 40 days, so that dates stay in range."""
    start = "(p_partkey % 60) * 40"
    return part.selectExpr(
        f"concat('C', {_padded('p_partkey + 1', 3)}) as campaign_id",
        "concat(' ', p_name, ' ', p_partkey) as campaign_name",
        f"{_pick('p_partkey % 6', CHANNELS)} as channel",
        f"{_pick('p_partkey % 6', PLATFORMS)} as platform",
        f"date_add(date'1995-01-01', cast({start} as int)) as start_date",
        f"date_add(date'1995-01-01', cast({start} + 30 + p_partkey * 7 % 151 as int)) as end_date",
        """case p_partkey % 100 when 0 then 2000D when 1 then 7000D when 2 then 10000D
           else cast(500 + p_partkey * 937 % 14000 as double) end as budget_euros""",
        "if(p_partkey % 7 = 0, null, p_type) as target_audience",
        f"{_pick('p_partkey % 3', [OBJECTIVES[0], ' Consideration', OBJECTIVES[2]])} as objective")


class Feeds:
    """The raw feeds over the parquet tables in ``sf_dir``, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _lineitem(self) -> DataFrame:
        return self._table("lineitem")

    @cached_property
    def impressions(self) -> DataFrame:
        return raw_impressions(self._lineitem)

    @cached_property
    def clicks(self) -> DataFrame:
        return raw_clicks(self._lineitem)

    @cached_property
    def conversions(self) -> DataFrame:
        return raw_conversions(self._lineitem, self._table("orders"))

    @cached_property
    def campaigns(self) -> DataFrame:
        return raw_campaigns(self._table("part"))
