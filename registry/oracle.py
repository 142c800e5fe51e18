"""SQL for the check engine: one independent formulation per registered query.

Arithmetic is spelled out (double literals, explicit rounding, integer money sums) so that
both engines evaluate the same IEEE operations.  Dates and timestamps are compared as text.
"""

from __future__ import annotations

import re

# --------------------------------------------------------------------------- expressions


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def txt(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n.split('.')[-1]}" for n in names)


def rnd(expr: str, digits: int = 2) -> str:
    s = f"1e{digits}"
    return (f"(CASE WHEN ({expr}) < 0 THEN 0e0 - floor(abs({expr}) * {s} + 5e-1) / {s} "
            f"ELSE floor(({expr}) * {s} + 5e-1) / {s} END)")


def div(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0e0))"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


_UNIT = 2**66


def units(expr: str) -> str:
    """A double as a whole number of 2**-66 units in 128 bits."""
    size = f"abs(CAST({expr} AS DOUBLE))"
    return (f"((CASE WHEN ({expr}) < 0 THEN -1 ELSE 1 END) * (CAST(floor({size}) AS HUGEINT) * {_UNIT} "
            f"+ CAST(floor(({size} - floor({size})) * {_UNIT}e0) AS HUGEINT)))")


def value(sum_of_units: str) -> str:
    """The double of a sum of units."""
    return (f"list_transform([CAST({sum_of_units} AS HUGEINT)], lambda s: (CASE WHEN s < 0 THEN -1e0 ELSE 1e0 END) * (CAST(abs(s) // {_UNIT} AS DOUBLE) "
            f"+ (CAST(abs(s) % {_UNIT} // {2**22} AS DOUBLE) / {2**44}e0 + CAST(abs(s) % {_UNIT} % {2**22} AS DOUBLE) / {_UNIT}e0)))[1]")


def money(expr: str, where: str | None = None) -> str:
    """The exact sum of a double column."""
    cond = f" FILTER (WHERE {where})" if where else ""
    return value(f"sum({units(expr)}){cond}")


EUROS = "(CAST((cost_micros + 50) // 100 AS DOUBLE) / 1e4)"
WEEK = "date_trunc('week', {0})"
MONTH = "CAST(date_trunc('month', {0}) AS DATE)"

# --------------------------------------------------------------------------- shared parts

FEEDS = {
    "fx_impressions": """
SELECT 'I' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS impression_id,
       'C' || lpad(CAST(1 + l_partkey AS STRING), CAST(greatest(3, length(CAST(1 + l_partkey AS STRING))) AS INT), '0') AS campaign_id,
       CAST((l_partkey + l_orderkey + l_linenumber) % 6 AS INT) AS ch,
       l_shipdate + INTERVAL '1' SECOND * ((l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 13) % 86400) AS ts,
       CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 'mobile' WHEN l_partkey % 3 = 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
       CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_suppkey % 6 = 0 THEN 'ES' WHEN l_suppkey % 6 = 1 THEN 'FR' WHEN l_suppkey % 6 = 2 THEN 'DE' WHEN l_suppkey % 6 = 3 THEN 'PT' WHEN l_suppkey % 6 = 4 THEN 'IT' ELSE 'UK' END AS country,
       5000 + (l_partkey * 7919 + l_orderkey * 31) % 495001 AS cost_micros,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem""",
    "fx_named": """
SELECT *, CASE ch WHEN 0 THEN 'Google_Ads' WHEN 1 THEN 'Meta_Ads' WHEN 2 THEN 'TikTok_Ads' WHEN 3 THEN 'LinkedIn_Ads' WHEN 4 THEN 'Email' ELSE 'SEO' END AS chan,
          CASE ch WHEN 0 THEN 'google' WHEN 1 THEN 'meta' WHEN 2 THEN 'tiktok' WHEN 3 THEN 'linkedin' WHEN 4 THEN 'email' ELSE 'organic' END AS plat
FROM fx_impressions""",
    "raw_ad_impressions": """
SELECT impression_id, campaign_id,
       CASE WHEN l_linenumber = 7 THEN '  ' || lower(chan) || ' ' ELSE chan END AS channel,
       CASE WHEN l_linenumber = 7 THEN upper(plat) || ' ' ELSE plat END AS platform,
       ts AS timestamp, device_type, country, cost_micros
FROM fx_named""",
    "fx_clicks": """
SELECT 'K' || impression_id AS click_id, impression_id, campaign_id, chan, plat,
       ts + INTERVAL '1' SECOND * (1 + (l_partkey * 31 + l_orderkey) % 3600) AS cts,
       device_type, country, cost_micros, l_orderkey, l_linenumber, l_partkey
FROM (SELECT *, row_number() OVER (PARTITION BY impression_id ORDER BY ts DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM fx_named) x
WHERE rn = 1 AND (l_orderkey * 31 + l_linenumber * 17) % 100 < 24""",
    "raw_clicks": """
SELECT click_id, CASE WHEN l_orderkey % 97 = 0 THEN 'I-orphan-' || CAST(l_orderkey AS STRING) ELSE impression_id END AS impression_id,
       campaign_id, chan AS channel, plat AS platform, cts AS timestamp, device_type, country, cost_micros
FROM fx_clicks
UNION ALL
SELECT click_id, impression_id, campaign_id, chan, plat, cts - INTERVAL '1' SECOND, device_type, country, cost_micros
FROM fx_clicks WHERE l_orderkey % 50 = 1""",
    "fx_conversions": """
SELECT 'V' || click_id AS conversion_id, click_id, campaign_id,
       'CUST-' || lpad(CAST(o_custkey AS STRING), CAST(greatest(5, length(CAST(o_custkey AS STRING))) AS INT), '0') AS customer_id,
       cts + INTERVAL '1' SECOND * (60 * (1 + (l_partkey * 17 + l_orderkey) % 1440)) AS vts,
       CASE (l_partkey + l_orderkey) % 3 WHEN 0 THEN 'purchase' WHEN 1 THEN 'lead' ELSE 'signup' END AS ctype,
       (l_partkey * 37 + l_orderkey * 101) AS r, l_orderkey
FROM fx_clicks JOIN orders ON l_orderkey = o_orderkey
WHERE (l_orderkey * 13 + l_linenumber * 29 + l_partkey) % 100 < 29""",
    "raw_conversions": """
SELECT conversion_id, CASE WHEN l_orderkey % 89 = 0 THEN 'K-orphan-' || CAST(l_orderkey AS STRING) ELSE click_id END AS click_id,
       campaign_id, customer_id, vts AS timestamp,
       CASE WHEN ctype = 'signup' THEN CASE WHEN r % 41 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END
            WHEN ctype = 'lead' THEN CAST(r % 50001 AS DOUBLE) / CAST(100 AS DOUBLE)
            WHEN r % 29 = 0 THEN CAST(50 AS DOUBLE) WHEN r % 31 = 0 THEN CAST(200 AS DOUBLE)
            ELSE CAST(500 + r % 199501 AS DOUBLE) / CAST(100 AS DOUBLE) END AS revenue,
       CASE WHEN r % 19 = 0 THEN ' ' || upper(ctype) ELSE ctype END AS conversion_type
FROM fx_conversions
UNION ALL
SELECT conversion_id, click_id, campaign_id, customer_id, vts - INTERVAL '1' SECOND, CAST(1 AS DOUBLE), ctype
FROM fx_conversions WHERE l_orderkey % 40 = 3""",
    "raw_campaigns": """
SELECT 'C' || lpad(CAST(p_partkey + 1 AS STRING), CAST(greatest(3, length(CAST(p_partkey + 1 AS STRING))) AS INT), '0') AS campaign_id, ' ' || p_name || ' ' || CAST(p_partkey AS STRING) AS campaign_name,
       CASE p_partkey % 6 WHEN 0 THEN 'Google_Ads' WHEN 1 THEN 'Meta_Ads' WHEN 2 THEN 'TikTok_Ads' WHEN 3 THEN 'LinkedIn_Ads' WHEN 4 THEN 'Email' ELSE 'SEO' END AS channel,
       CASE p_partkey % 6 WHEN 0 THEN 'google' WHEN 1 THEN 'meta' WHEN 2 THEN 'tiktok' WHEN 3 THEN 'linkedin' WHEN 4 THEN 'email' ELSE 'organic' END AS platform,
       CAST(DATE '1995-01-01' + INTERVAL '1' DAY * ((p_partkey % 60) * 40) AS DATE) AS start_date,
       CAST(DATE '1995-01-01' + INTERVAL '1' DAY * ((p_partkey % 60) * 40 + 30 + p_partkey * 7 % 151) AS DATE) AS end_date,
       CASE p_partkey % 100 WHEN 0 THEN CAST(2000 AS DOUBLE) WHEN 1 THEN CAST(7000 AS DOUBLE) WHEN 2 THEN CAST(10000 AS DOUBLE)
            ELSE CAST(500 + p_partkey * 937 % 14000 AS DOUBLE) END AS budget_euros,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS target_audience,
       CASE p_partkey % 3 WHEN 0 THEN 'awareness' WHEN 1 THEN ' Consideration' ELSE 'conversion' END AS objective
FROM part""",
}


def _newest(table: str, key: str, rest: str) -> str:
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in rest.split(","))
    return f"SELECT DISTINCT ON ({key}) * FROM {table} ORDER BY {key}, timestamp DESC, {order}"


def _event_columns(prefix: str, ts: str) -> str:
    return (f"upper(trim(channel)) AS channel, lower(trim(platform)) AS platform, timestamp AS {ts}, "
            f"CAST(timestamp AS DATE) AS {prefix}_date, {WEEK.format('timestamp')} AS {prefix}_week, "
            f"{MONTH.format('timestamp')} AS {prefix}_month, ifnull(device_type, 'unknown') AS device_type, "
            f"ifnull(country, 'XX') AS country, cost_micros, {EUROS} AS cost_euros")


STAGED = {
    "imp": f"""
SELECT impression_id, campaign_id, {_event_columns('impression', 'timestamp')}
FROM ({_newest('raw_ad_impressions', 'impression_id', 'campaign_id, channel, platform, device_type, country, cost_micros')})""",
    "camp": """
SELECT campaign_id, trim(campaign_name) AS campaign_name, upper(trim(channel)) AS channel,
       lower(trim(platform)) AS platform, start_date, end_date,
       CAST(end_date - start_date AS BIGINT) AS campaign_duration_days, budget_euros,
       CASE WHEN budget_euros < 2000 THEN 'small' WHEN budget_euros <= 7000 THEN 'medium'
            WHEN budget_euros <= 10000 THEN 'large' ELSE 'enterprise' END AS budget_tier,
       ifnull(target_audience, 'unspecified') AS target_audience, lower(trim(objective)) AS objective,
       CASE WHEN upper(trim(channel)) = 'GOOGLE_ADS' THEN 'Paid Search'
            WHEN upper(trim(channel)) IN ('META_ADS', 'TIKTOK_ADS', 'LINKEDIN_ADS') THEN 'Paid Social'
            WHEN upper(trim(channel)) = 'EMAIL' THEN 'Owned'
            WHEN upper(trim(channel)) = 'SEO' THEN 'Organic' ELSE 'Other' END AS channel_group
FROM raw_campaigns""",
    "clk0": f"""
SELECT click_id, impression_id, campaign_id, {_event_columns('click', 'click_timestamp')}
FROM ({_newest('raw_clicks', 'click_id', 'impression_id, campaign_id, channel, platform, device_type, country, cost_micros')})""",
    "clk": """
SELECT k.*, i.timestamp AS impression_timestamp,
       date_sub('second', i.timestamp, k.click_timestamp) AS seconds_to_click
FROM clk0 k LEFT JOIN imp i USING (impression_id)""",
    "cv0": f"""
SELECT conversion_id, click_id, campaign_id, customer_id, timestamp AS conversion_timestamp,
       CAST(timestamp AS DATE) AS conversion_date, {WEEK.format('timestamp')} AS conversion_week,
       {MONTH.format('timestamp')} AS conversion_month, ifnull(revenue, 0e0) AS revenue_euros,
       lower(trim(conversion_type)) AS conversion_type
FROM ({_newest('raw_conversions', 'conversion_id', 'click_id, campaign_id, customer_id, revenue, conversion_type')})""",
    "cv": """
SELECT v.*, k.channel, k.platform, k.device_type, k.country, k.click_timestamp,
       date_sub('minute', k.click_timestamp, v.conversion_timestamp) AS minutes_to_convert,
       CASE WHEN revenue_euros = 0 THEN 'no_value' WHEN revenue_euros < 50 THEN 'low'
            WHEN revenue_euros <= 200 THEN 'medium' WHEN revenue_euros <= 500 THEN 'high'
            ELSE 'premium' END AS revenue_tier,
       CASE WHEN conversion_type IN ('purchase', 'signup', 'lead')
            THEN upper(conversion_type[1]) || conversion_type[2:] ELSE 'Other' END AS conversion_type_label
FROM cv0 v LEFT JOIN clk0 k USING (click_id)""",
}

_TYPES = ", ".join(f"count(*) FILTER (WHERE conversion_type = '{t}') AS {n}"
                   for n, t in (("purchases", "purchase"), ("signups", "signup"), ("leads", "lead")))


def _performance(grain: str) -> str:
    return f"""
SELECT c.campaign_id, campaign_name, channel, platform, objective, budget_euros, budget_tier, channel_group,
       campaign_duration_days, start_date, end_date,
       ifnull(ni, 0) AS total_impressions, ifnull(nk, 0) AS total_clicks, ifnull(nv, 0) AS total_conversions,
       ifnull(spend, 0e0) AS total_cost_euros, ifnull(revenue, 0e0) AS total_revenue_euros,
       ifnull(purchases, 0) AS total_purchases, ifnull(signups, 0) AS total_signups,
       ifnull(leads, 0) AS total_leads, ifnull(nc, 0) AS unique_customers,
       {div('nk', 'ni')} AS ctr, {div('spend', 'nk')} AS cpc_euros, {div('spend', 'nv')} AS cpa_euros,
       {div('revenue', 'spend')} AS roas, {div('nv', 'nk')} AS conversion_rate
FROM camp c
LEFT JOIN (SELECT campaign_id, count(*) AS ni, {money('cost_euros')} AS spend FROM imp GROUP BY {grain}) USING (campaign_id)
LEFT JOIN (SELECT campaign_id, count(*) AS nk FROM clk0 GROUP BY 1) USING (campaign_id)
LEFT JOIN (SELECT campaign_id, count(*) AS nv, {money('revenue_euros')} AS revenue, {_TYPES},
                  count(DISTINCT customer_id) AS nc FROM cv0 GROUP BY 1) USING (campaign_id)"""


def _dashboard(how: str) -> str:
    return f"""
SELECT CAST(date AS VARCHAR) AS date, channel, platform, ifnull(ni, 0) AS impressions, ifnull(nk, 0) AS clicks,
       ifnull(nv, 0) AS conversions, {rnd('ifnull(spend, 0e0)')} AS spend_euros,
       {rnd('ifnull(revenue, 0e0)')} AS revenue_euros, {rnd(div('nk', 'ni') + ' * 1e2')} AS ctr_pct,
       {rnd(div('spend', 'nk'))} AS cpc_eur, {rnd(div('spend', 'nv'))} AS cpa_eur,
       {rnd(div('revenue', 'spend'))} AS roas, {rnd(div('nv', 'nk') + ' * 1e2')} AS conversion_rate_pct,
       ifnull(purchases, 0) AS purchases, ifnull(signups, 0) AS signups, ifnull(leads, 0) AS leads,
       {rnd(div('spend', 'revenue') + ' * 1e2')} AS cost_of_revenue_pct
FROM (SELECT impression_date AS date, channel, platform, count(*) AS ni, {money('cost_euros')} AS spend
      FROM imp GROUP BY ALL) i
{how} JOIN (SELECT click_date AS date, channel, platform, count(*) AS nk FROM clk0 GROUP BY ALL) k
     USING (date, channel, platform)
{how} JOIN (SELECT conversion_date AS date, channel, platform, count(*) AS nv, {money('revenue_euros')} AS revenue, {_TYPES}
            FROM cv GROUP BY ALL) v USING (date, channel, platform)"""


_ROI = f"""
SELECT channel, total_impressions, total_clicks, total_conversions,
       {rnd('spend')} AS total_spend_euros, {rnd('revenue')} AS total_revenue_euros,
       {rnd('revenue - spend')} AS profit_euros, {rnd(div('revenue - spend', 'spend') + ' * 1e2')} AS roi_pct,
       {rnd(div('spend', 'total_conversions'))} AS avg_cpa_eur, {rnd(div('revenue', 'spend'))} AS avg_roas,
       {rnd(div('total_clicks', 'total_impressions') + ' * 1e2')} AS ctr_pct,
       {rnd(div('total_conversions', 'total_clicks') + ' * 1e2')} AS conversion_rate_pct,
       best_campaign_name, best_campaign_roas, worst_campaign_name, worst_campaign_roas,
       CASE WHEN raw_score IS NULL THEN NULL WHEN raw_score < 0 THEN 0e0
            WHEN raw_score > 100 THEN 1e2 ELSE raw_score END AS channel_health_score
FROM (SELECT *, {rnd(div('revenue', 'spend') + ' * 4e1 + ' + div('total_clicks', 'total_impressions')
                     + ' * 1e2 * 3e1 + ' + div('total_conversions', 'total_clicks') + ' * 1e2 * 3e1', 0)} AS raw_score
      FROM (SELECT channel, {big('sum(total_impressions)')} AS total_impressions,
                   {big('sum(total_clicks)')} AS total_clicks, {big('sum(total_conversions)')} AS total_conversions,
                   {money('total_cost_euros')} AS spend, {money('total_revenue_euros')} AS revenue
            FROM perf GROUP BY 1)
      LEFT JOIN picks USING (channel))"""

_PICKS = f"""
SELECT channel, b.campaign_name AS best_campaign_name, {rnd('b.roas')} AS best_campaign_roas,
       w.campaign_name AS worst_campaign_name, {rnd('w.roas')} AS worst_campaign_roas
FROM (SELECT * FROM perf WHERE total_cost_euros > 0
      QUALIFY row_number() OVER (PARTITION BY channel ORDER BY roas DESC NULLS LAST, campaign_id) = 1) b
JOIN (SELECT * FROM perf WHERE total_cost_euros > 0
      QUALIFY row_number() OVER (PARTITION BY channel ORDER BY roas ASC NULLS LAST, campaign_id) = 1) w USING (channel)"""

_SINCE = "date_sub('day', first_ts, conversion_timestamp)"
_LTV = f"""
SELECT customer_id, sum(CASE WHEN {_SINCE} <= 30 THEN {units('revenue_euros')} ELSE 0 END) AS u30,
       sum(CASE WHEN {_SINCE} <= 90 THEN {units('revenue_euros')} ELSE 0 END) AS u90,
       sum({units('revenue_euros')}) AS u, count(*) AS n
FROM (SELECT *, min(conversion_timestamp) OVER (PARTITION BY customer_id) AS first_ts FROM cv0) GROUP BY 1"""

_FIRST = """
SELECT customer_id, channel AS acquisition_channel, platform AS acquisition_platform,
       campaign_id AS acquisition_campaign_id, conversion_timestamp AS acquisition_timestamp,
       date_trunc('month', conversion_timestamp) AS acquisition_month
FROM (SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY conversion_timestamp) AS pos FROM cv) WHERE pos = 1"""

_CAC = div("spend", "new_customers")
_AVG90 = "(s90 / CAST(events AS DOUBLE))"
_AVG30 = "(s30 / CAST(events AS DOUBLE))"
_RATIO = f"({_AVG90} / nullif({_CAC}, 0e0))"
_ACQ = f"""
SELECT channel, acquisition_month, new_customers, {rnd(_CAC)} AS cac_eur, {rnd(_AVG30)} AS avg_first_order_value,
       {rnd(_AVG30)} AS avg_ltv_30d, {rnd(_AVG90)} AS avg_ltv_90d,
       {rnd(f"({_CAC} / nullif({_AVG90} / 9e1, 0e0))", 0)} AS payback_period_days,
       {rnd(_RATIO)} AS ltv_90d_to_cac_ratio,
       CASE WHEN {_RATIO} >= 3 THEN 'healthy' WHEN {_RATIO} >= 1 THEN 'marginal' ELSE 'unhealthy' END AS acquisition_health,
       {rnd(div('sn', 'events'), 1)} AS avg_conversions_per_customer
FROM (SELECT acquisition_channel AS channel, acquisition_month, count(DISTINCT customer_id) AS new_customers,
             count(*) AS events, {value('sum(u30)')} AS s30, {value('sum(u90)')} AS s90, sum(n) AS sn
      FROM firsts JOIN ltv USING (customer_id) GROUP BY 1, 2)
LEFT JOIN (SELECT channel, {money('total_cost_euros')} AS spend FROM perf GROUP BY 1) USING (channel)"""

# The literal product of conversions and touches; only the check engine builds it.
_JOURNEY = """
SELECT v.conversion_id, v.customer_id, v.revenue_euros, v.conversion_type, k.channel AS attributed_channel,
       k.platform AS attributed_platform, k.campaign_id AS attributed_campaign_id, k.click_timestamp, k.click_id
FROM cv0 v JOIN {touch} k ON {match} k.click_timestamp <= v.conversion_timestamp"""
_TOUCH_GROUP = "attributed_channel, attributed_platform, attributed_campaign_id"


def _single(journey: str) -> str:
    pick = "SELECT *, '{1}_touch' AS attribution_model FROM {2} QUALIFY row_number() OVER (PARTITION BY conversion_id ORDER BY click_timestamp {0}, click_id {0}) = 1"
    both = " UNION ALL ".join(f"({pick.format(o, m, journey)})" for o, m in (("ASC", "first"), ("DESC", "last")))
    return f"""
SELECT conversion_id, customer_id, revenue_euros, conversion_type, {_TOUCH_GROUP},
       revenue_euros AS attributed_revenue, 1e0 AS attribution_weight, attribution_model FROM ({both})"""


def _linear(journey: str) -> str:
    return f"""
SELECT {_TOUCH_GROUP}, count(*) AS touches, {money('revenue_euros / n')} AS attributed_revenue,
       {money('1e0 / n')} AS attribution_weight, 'linear' AS attribution_model
FROM (SELECT *, count(*) OVER (PARTITION BY conversion_id) AS n FROM {journey}) GROUP BY {_TOUCH_GROUP}"""


def _credit(journey: str) -> str:
    return f"""
SELECT conversion_id, any_value(customer_id) AS customer_id, any_value(revenue_euros) AS revenue_euros,
       any_value(conversion_type) AS conversion_type, count(*) AS total_touches,
       any_value(revenue_euros) / count(*) AS attributed_revenue, 1e0 / count(*) AS attribution_weight
FROM {journey} GROUP BY conversion_id"""


def _summary(journey: str) -> str:
    single = f"SELECT * FROM ({_single(journey)})"
    return f"""
SELECT attribution_model, {_TOUCH_GROUP}, count(*) AS touches, {money('attributed_revenue')} AS attributed_revenue,
       {money('attribution_weight')} AS attribution_weight FROM ({single}) GROUP BY ALL
UNION ALL BY NAME {_linear(journey)}"""


def _credit_by(journey: str) -> str:
    return f"""
SELECT conversion_id, any_value(customer_id) AS customer_id, any_value(revenue_euros) AS revenue_euros, any_value(conversion_type) AS conversion_type,
       attributed_channel, count(*) AS touches, any_value(n) AS total_touches,
       any_value(revenue_euros) * {dbl('count(*)')} / {dbl('any_value(n)')} AS attributed_revenue,
       {dbl('count(*)')} / {dbl('any_value(n)')} AS attribution_weight
FROM (SELECT *, count(*) OVER (PARTITION BY conversion_id) AS n FROM {journey}) GROUP BY conversion_id, attributed_channel"""


_LAST_CLICK = f"""
SELECT conversion_id, customer_id, {txt('conversion_timestamp')}, click_id, channel, platform, {txt('click_timestamp')}
FROM (SELECT v.conversion_id, v.customer_id, v.conversion_timestamp, k.click_id, k.channel, k.platform, k.click_timestamp
      FROM cv0 v LEFT JOIN clk0 k ON k.click_timestamp <= v.conversion_timestamp
      QUALIFY row_number() OVER (PARTITION BY conversion_id ORDER BY k.click_timestamp DESC, k.click_id DESC) = 1)"""
_NEXT_CLICK = f"""
SELECT conversion_id, campaign_id, {txt('conversion_timestamp')}, click_id AS next_click_id, {txt('click_timestamp')}
FROM (SELECT v.conversion_id, v.campaign_id, v.conversion_timestamp, k.click_id, k.click_timestamp
      FROM cv0 v LEFT JOIN clk0 k ON k.campaign_id = v.campaign_id AND k.click_timestamp > v.conversion_timestamp
           AND k.click_timestamp <= v.conversion_timestamp + INTERVAL 60 DAY
      QUALIFY row_number() OVER (PARTITION BY conversion_id ORDER BY k.click_timestamp, k.click_id) = 1)"""


def _touch_positions(journey: str, touch: str, by: str = "") -> str:
    def flag(order: str) -> str:
        ends = (f"SELECT {by}click_id FROM {journey} QUALIFY row_number() OVER (PARTITION BY conversion_id "
                f"ORDER BY click_timestamp {order}, click_id {order}) = 1")
        return f"({by}click_id) IN ({ends})"

    within = f"PARTITION BY {by.strip(', ')}" if by else ""
    return f"""
SELECT {by}click_id, {txt('click_timestamp')}, channel AS attributed_channel, platform AS attributed_platform,
       campaign_id AS attributed_campaign_id,
       row_number() OVER ({within} ORDER BY click_timestamp, click_id) AS touch_sequence,
       {flag('ASC')} AS is_first_touch, {flag('DESC')} AS is_last_touch FROM {touch}"""


# As many draws as the sample has rows: a hash of seed, values and the number of the copy.
_CLICK = "click_id, impression_id, campaign_id, channel, platform, timestamp, device_type, country, cost_micros"
_DRAWN = ", ".join(f"coalesce(CAST({c.strip()} AS VARCHAR), '~')" for c in (*_CLICK.split(","), "copy"))

PARTS = {
    **FEEDS,
    "sampled_clicks": f"""
SELECT {_CLICK} FROM (SELECT *, row_number() OVER (PARTITION BY {_CLICK}) AS copy FROM raw_clicks)
ORDER BY md5(concat_ws('|', '42', {_DRAWN})) LIMIT 1000""",
    "own_touch": "SELECT DISTINCT v.customer_id, k.* FROM cv0 v JOIN clk0 k USING (click_id)",
    "journey": _JOURNEY.format(touch="clk0", match=""),
    "own_journey": _JOURNEY.format(touch="own_touch", match="k.customer_id = v.customer_id AND"),
    **STAGED,
    "perf": _performance("campaign_id, channel, platform"),
    "perf1": _performance("campaign_id"),
    "dash": _dashboard("LEFT"),
    "dash_full": _dashboard("FULL"),
    "picks": _PICKS,
    "roi": _ROI,
    "ltv": _LTV,
    "firsts": _FIRST,
    "acq": _ACQ,
}


# The channel report over a range of days: the same parts over narrowed feeds.
_RANGE = "BETWEEN DATE '1997-04-02' AND DATE '1997-06-30'"
PARTS |= {"imp_in": f"SELECT * FROM imp WHERE impression_date {_RANGE}", "clk0_in": f"SELECT * FROM clk0 WHERE click_date {_RANGE}",
          "cv0_in": f"SELECT * FROM cv0 WHERE conversion_date {_RANGE}"}


def _narrowed(sql: str) -> str:
    return re.sub(r"\b(imp|clk0|cv0|perf|picks)\b", r"\1_in", sql)


PARTS |= {"perf_in": _narrowed(PARTS["perf"]), "picks_in": _narrowed(_PICKS), "roi_in": _narrowed(_ROI)}


def needed(sql: str, seen: dict[str, None] | None = None) -> dict[str, None]:
    """Names of the shared parts a statement uses, in dependency order."""
    seen = {} if seen is None else seen
    for name in PARTS:
        if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+\(*\s*{name}\b", sql):
            needed(PARTS[name], seen)
            seen[name] = None
    return seen


def statement(sql: str) -> str:
    parts = needed(sql)
    if not parts:
        return sql
    ctes = ",\n".join(f"{name} AS ({PARTS[name]}\n)" for name in parts)
    return f"WITH {ctes}\n{sql}"


_CAMPAIGN_COLUMNS = f"* REPLACE ({txt('start_date', 'end_date')})"

QUERIES: dict[str, str] = {
    "stg_ad_impressions": f"""SELECT * REPLACE ({txt('timestamp', 'impression_date', 'impression_week', 'impression_month')}) FROM imp""",
    "stg_campaigns": f"SELECT {_CAMPAIGN_COLUMNS} FROM camp",
    "stg_clicks": f"""SELECT * REPLACE ({txt('click_timestamp', 'click_date', 'click_week', 'click_month', 'impression_timestamp')}) FROM clk""",
    "stg_conversions": f"""SELECT * REPLACE ({txt('conversion_timestamp', 'conversion_date', 'conversion_week', 'conversion_month', 'click_timestamp')}) FROM cv""",
    "dedup_latest": """
SELECT a.conversion_id, a.click_id, a.campaign_id, a.customer_id, CAST(a.timestamp AS VARCHAR) AS timestamp,
       a.revenue, a.conversion_type
FROM raw_conversions a
JOIN (SELECT conversion_id, max(timestamp) AS timestamp FROM raw_conversions GROUP BY 1) USING (conversion_id, timestamp)""",
    "int_campaign_performance": f"SELECT {_CAMPAIGN_COLUMNS} FROM perf",
    "int_campaign_performance_campaign_grain": f"SELECT {_CAMPAIGN_COLUMNS} FROM perf1",
    "unique_customers_by_sketch": """
SELECT 'campaign_id' AS span, campaign_id AS value, count(DISTINCT customer_id) AS unique_customers, true AS within_error
FROM cv0 WHERE conversion_date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' GROUP BY 2
UNION ALL
SELECT 'month', CAST(CAST(date_trunc('month', conversion_date) AS DATE) AS VARCHAR), count(DISTINCT customer_id), true FROM cv0 GROUP BY 2""",
    "click_engagement": f"""
SELECT campaign_id, count(*) AS total_clicks, {money('cost_euros')} AS click_spend_euros,
       {dbl('sum(seconds_to_click)')} / nullif(count(seconds_to_click), 0) AS avg_seconds_to_click
FROM clk GROUP BY 1""",
    "rpt_marketing_dashboard": "SELECT * FROM dash",
    "rpt_marketing_dashboard_full": "SELECT * FROM dash_full",
    "best_worst_campaign": "SELECT * FROM picks",
    "rpt_channel_roi": "SELECT * FROM roi",
    "first_conversion": f"""SELECT * REPLACE ({txt('acquisition_timestamp', 'acquisition_month')}) FROM firsts""",
    "ltv_windows": f"""
SELECT customer_id, {value('u30')} AS ltv_30d, {value('u90')} AS ltv_90d, {value('u')} AS ltv_total, n AS total_conversions FROM ltv""",
    "rpt_customer_acquisition": f"SELECT * REPLACE ({txt('acquisition_month')}) FROM acq",
    "attribution_global_first_last": _single("journey"),
    "attribution_global_linear_by_channel": _linear("journey"),
    "attribution_global_linear_credit": _credit("journey"),
    "attribution_global_summary": _summary("journey"),
    "attribution_customer_first_last": _single("own_journey"),
    "attribution_customer_linear_by_channel": _linear("own_journey"),
    "attribution_customer_linear_credit": _credit("own_journey"),
    "attribution_customer_summary": _summary("own_journey"),
    "asof_last_click": _LAST_CLICK,
    "asof_next_campaign_click": _NEXT_CLICK,
    "linear_credit_by_channel": _credit_by("journey"),
    "linear_credit_by_channel_customer": _credit_by("own_journey"),
    "touch_positions_global": _touch_positions("journey", "clk0"),
    "touch_positions_customer": _touch_positions("own_journey", "own_touch", "customer_id, "),
}

_SUMS = ", ".join(f"{big(f'sum({c})')} AS total_{c}" for c in ("impressions", "clicks", "conversions", "purchases", "signups", "leads"))
_SPEND, _REVENUE = money("spend_euros"), money("revenue_euros")
_DASH_MEASURES = f"""{_SUMS}, {_SPEND} AS total_spend, {_REVENUE} AS total_revenue,
       count(DISTINCT date) AS count_days, {_REVENUE} - {_SPEND} AS total_profit,
       {div('sum(clicks)', 'sum(impressions)')} * 1e2 AS avg_ctr, {div(_SPEND, 'sum(clicks)')} AS avg_cpc,
       {div(_SPEND, 'sum(conversions)')} AS avg_cpa, {div(_REVENUE, _SPEND)} AS overall_roas,
       {div('sum(conversions)', 'sum(clicks)')} * 1e2 AS avg_conversion_rate"""


def _mean(column: str) -> str:
    return f"({money(column)} / nullif(CAST(count({column}) AS DOUBLE), 0e0))"


_WEIGHTED_CAC = f"({money('cac_eur * new_customers')} / nullif(CAST(sum(new_customers) AS DOUBLE), 0e0))"
_ACQ_MEASURES = f"""{big('sum(new_customers)')} AS total_new_customers, {_WEIGHTED_CAC} AS avg_cac,
       {_mean('avg_first_order_value')} AS avg_first_order_value, {_mean('avg_ltv_30d')} AS avg_ltv_30d,
       {_mean('avg_ltv_90d')} AS avg_ltv_90d, {_mean('payback_period_days')} AS avg_payback_period,
       {_mean('ltv_90d_to_cac_ratio')} AS avg_ltv_cac_ratio,
       {_mean('avg_conversions_per_customer')} AS avg_conversions_per_customer, count(*) AS channel_count"""
_ROI_MEASURES = f"""{big('sum(total_impressions)')} AS total_impressions, {big('sum(total_clicks)')} AS total_clicks,
       {big('sum(total_conversions)')} AS total_conversions, {money('total_spend_euros')} AS total_spend,
       {money('total_revenue_euros')} AS total_revenue, {money('profit_euros')} AS total_profit,
       {_mean('roi_pct')} AS avg_roi, {_mean('avg_cpa_eur')} AS avg_cpa, {_mean('avg_roas')} AS avg_roas,
       {_mean('ctr_pct')} AS avg_ctr, {_mean('conversion_rate_pct')} AS avg_conversion_rate,
       {_mean('channel_health_score')} AS channel_health_score, max(best_campaign_roas) AS best_campaign_roas,
       min(worst_campaign_roas) AS worst_campaign_roas, count(*) AS channel_count"""


def _graded(column: str, good: str, warn: str | None = None) -> str:
    middle = f" WHEN {column} {warn} THEN 'warn'" if warn else ""
    return (f"CASE WHEN {column} IS NULL THEN NULL WHEN {column} {good} THEN 'good'{middle} "
            f"ELSE 'bad' END AS {column}_rating")


_TREND = f"{_SPEND} AS spend, {_REVENUE} AS revenue, {big('sum(conversions)')} AS conversions, {big('sum(impressions)')} AS impressions"
_EVENTS = {"impressions": "impressions", "clicks": "clicks", "conversions": "conversions"}

QUERIES |= {
    "kpi_totals": f"""
SELECT {_SPEND} AS total_spend, {_REVENUE} AS total_revenue, {div(_REVENUE, _SPEND)} AS overall_roas,
       {big('sum(conversions)')} AS total_conversions, {div('sum(clicks)', 'sum(impressions)')} * 1e2 AS avg_ctr,
       {_REVENUE} - {_SPEND} AS total_profit FROM dash""",
    "spend_by_channel": f"SELECT channel, {_SPEND} AS total_spend FROM dash GROUP BY 1 ORDER BY 2 DESC",
    "roas_trend": f"SELECT date, {div(_REVENUE, _SPEND)} AS overall_roas FROM dash GROUP BY 1 ORDER BY 1",
    "conversion_funnel": f"""
SELECT {big('sum(impressions)')} AS total_impressions, {big('sum(clicks)')} AS total_clicks,
       {big('sum(conversions)')} AS total_conversions FROM dash""",
    "funnel": f"""
SELECT step_no, step, events, {div('events', 'lag(events) OVER (ORDER BY step_no)')} * 1e2 AS step_rate_pct,
       {div('events', 'first(events) OVER (ORDER BY step_no)')} * 1e2 AS overall_rate_pct
FROM (SELECT CAST(1 AS BIGINT) AS step_no, 'impressions' AS step, {big('sum(impressions)')} AS events FROM dash
      UNION ALL SELECT 2, 'clicks', {big('sum(clicks)')} FROM dash
      UNION ALL SELECT 3, 'conversions', {big('sum(conversions)')} FROM dash)""",
    "channel_roi_table": """
SELECT channel, best_campaign_name, total_spend_euros AS total_spend, total_revenue_euros AS total_revenue,
       roi_pct AS avg_roi, avg_roas, total_conversions, channel_health_score FROM roi ORDER BY roi_pct DESC""",
    "cac_by_channel_weighted": f"SELECT channel, {_WEIGHTED_CAC} AS avg_cac FROM acq GROUP BY 1",
    "revenue_vs_spend": f"""
SELECT channel, total_spend_euros AS total_spend, total_revenue_euros AS total_revenue,
       (SELECT {_mean('total_spend_euros')} FROM roi) AS mean_total_spend FROM roi""",
    "new_customers_by_channel": f"SELECT channel, {big('sum(new_customers)')} AS total_new_customers FROM acq GROUP BY 1",
    "ltv_cac_by_channel": f"SELECT channel, {_mean('ltv_90d_to_cac_ratio')} AS avg_ltv_cac_ratio FROM acq GROUP BY 1",
    "dashboard_measures_by_month": f"""
SELECT date[:7] || '-01' AS month, platform, {_DASH_MEASURES} FROM dash GROUP BY 1, 2""",
    "acquisition_measures_by_health": f"SELECT acquisition_health, {_ACQ_MEASURES} FROM acq GROUP BY 1",
    "last_12_months_acquisition": f"""
SELECT CAST(CAST(acquisition_month AS DATE) AS VARCHAR) AS acquisition_month,
       {big('sum(new_customers)')} AS total_new_customers, {_WEIGHTED_CAC} AS avg_cac
FROM acq WHERE acquisition_month >= DATE '2000-07-01' AND acquisition_month < DATE '2001-07-01' GROUP BY 1""",
    "channel_roi_measures": f"SELECT {_ROI_MEASURES} FROM roi",
    "channel_roi_date_range": "SELECT * FROM roi_in",
    "rating_bands": f"""
SELECT channel, avg_roas, roi_pct, channel_health_score, profit_euros, {_graded('avg_roas', '>= 3', '>= 1')},
       {_graded('roi_pct', '>= 100', '>= 0')}, {_graded('channel_health_score', '>= 70', '>= 40')},
       {_graded('profit_euros', '> 0')} FROM roi""",
    "acquisition_rating_bands": f"""
SELECT channel, {txt('acquisition_month')}, {_graded('payback_period_days', '<= 30', '<= 90')},
       {_graded('ltv_90d_to_cac_ratio', '>= 3', '>= 1')},
       {_graded('acquisition_health', "= 'healthy'", "= 'marginal'")} FROM acq""",
    "last_n_days_dashboard": f"""
SELECT CAST(CAST(date_trunc('week', CAST(date AS DATE)) AS DATE) AS VARCHAR) AS week, channel,
       {_SPEND} AS total_spend, {div(_REVENUE, _SPEND)} AS overall_roas, count(DISTINCT date) AS count_days
FROM dash WHERE date > '2001-04-01' AND date <= '2001-06-30' GROUP BY 1, 2""",
    "access_filtered_dashboard": f"""
SELECT channel, platform, {big('sum(clicks)')} AS total_clicks, {div(_SPEND, 'sum(clicks)')} AS avg_cpc
FROM dash WHERE channel IN ('EMAIL', 'SEO', 'META_ADS') AND platform IN ('email', 'meta') GROUP BY 1, 2""",
    "daily_channel_trend": f"""
SELECT date, channel, {_TREND} FROM dash WHERE date > '2001-04-01' AND date <= '2001-06-30' GROUP BY 1, 2""",
    "week_over_week": f"""
SELECT n.*, b.spend AS spend_before, b.revenue AS revenue_before, b.conversions AS conversions_before,
       b.impressions AS impressions_before, {div('n.spend - b.spend', 'b.spend')} * 1e2 AS spend_change_pct,
       {div('n.revenue - b.revenue', 'b.revenue')} * 1e2 AS revenue_change_pct
FROM trend n LEFT JOIN trend b ON b.channel = n.channel
     AND CAST(b.date AS DATE) + 7 = CAST(n.date AS DATE)""",
}
PARTS["trend"] = f"SELECT date, channel, {_TREND} FROM dash GROUP BY 1, 2"


def _suite(name: str, dataset: str, checks: list[tuple], source: str | None = None) -> str:
    """One SELECT per check: (type, column, what is bad, share that must be good)."""
    source = source or dataset
    rows = []
    for i, (kind, column, bad, *mostly) in enumerate(checks, 1):
        share = mostly[0] if mostly else 1
        col = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
        head = f"SELECT '{name}' AS suite_name, '{dataset}' AS dataset, {big(str(i))} AS check_no, 'expect_{kind}' AS expectation_type, {col} AS \"column\""
        none = "CAST(NULL AS BIGINT)"
        if kind.startswith("table_row_count"):
            rows.append(f"{head}, count(*) {bad} AS success, count(*) AS element_count, {none} AS missing_count, "
                        f"{none} AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent FROM {source}")
        elif kind == "column_to_exist":
            rows.append(f"{head}, true, {none}, {none}, {none}, CAST(NULL AS DOUBLE)")
        else:
            base = "n" if kind in ("column_values_to_not_be_null", "cost_is_positive") or "reference" in kind else "n - missing"
            rows.append(f"{head}, ifnull(({base} - bad) / nullif(CAST({base} AS DOUBLE), 0e0) >= {share}, true) AS success, n AS element_count, missing AS missing_count, bad AS unexpected_count, "
                        f"ifnull({rnd(f'bad * 100 / nullif(CAST({base} AS DOUBLE), 0e0)', 4)}, 0e0) AS unexpected_percent "
                        f"FROM (SELECT count(*) AS n, count(*) - count({column}) AS missing, "
                        f"count(*) FILTER (WHERE {bad}) AS bad FROM {source})")
    return "\nUNION ALL ".join(rows)


def _not_null(*columns: str) -> list[tuple]:
    return [("column_values_to_not_be_null", c, f"{c} IS NULL") for c in columns]


def _exist(*columns: str) -> list[tuple]:
    return [("column_to_exist", c, "") for c in columns]


def _repeated(column: str, table: str) -> tuple:
    return ("column_values_to_be_unique", column,
            f"{column} IN (SELECT {column} FROM {table} GROUP BY 1 HAVING count(*) > 1)")


def _among(column: str, *values: str) -> tuple:
    return ("column_values_to_be_in_set", column, f"{column} NOT IN ({', '.join(repr(v) for v in values)})")


def _outside(column: str, low: object, high: object = None, mostly: object = 1) -> tuple:
    bad = f"{column} < {low}" + (f" OR {column} > {high}" if high is not None else "")
    return ("column_values_to_be_between", column, bad, mostly)


_CHANNEL_SET = _among("channel", "Google_Ads", "Meta_Ads", "TikTok_Ads", "LinkedIn_Ads", "Email", "SEO")
_SUITES = {
    "raw_impressions_suite": ("raw_ad_impressions", [
        ("table_row_count_to_be_between", None, ">= 1000000"),
        *_not_null("impression_id", "campaign_id", "channel", "timestamp"),
        _repeated("impression_id", "raw_ad_impressions"), _CHANNEL_SET,
        _among("device_type", "mobile", "desktop", "tablet"), _among("country", "ES", "FR", "DE", "PT", "IT", "UK"),
        _outside("cost_micros", 0, 1000000, 0.99),
        ("column_values_to_match_regex", "campaign_id", "NOT regexp_matches(campaign_id, 'C[0-9][0-9][0-9]')"),
        *_exist("impression_id", "campaign_id", "channel", "platform", "timestamp", "device_type", "country",
                "cost_micros")]),
    "raw_clicks_suite": ("raw_clicks", [
        ("table_row_count_to_be_between", None, ">= 100000"),
        *_not_null("click_id", "impression_id", "campaign_id", "timestamp"), _repeated("click_id", "raw_clicks"),
        _outside("cost_micros", 0, 1000000, 0.99), _CHANNEL_SET,
        *_exist("click_id", "impression_id", "campaign_id", "channel", "platform", "timestamp", "device_type",
                "country", "cost_micros")]),
    "raw_conversions_suite": ("raw_conversions", [
        ("table_row_count_to_be_between", None, ">= 50000"),
        *_not_null("conversion_id", "click_id", "campaign_id", "timestamp", "revenue"),
        _repeated("conversion_id", "raw_conversions"), _outside("revenue", 0.01, 10000, 0.99),
        _among("conversion_type", "purchase", "signup", "lead"),
        *_exist("conversion_id", "click_id", "campaign_id", "customer_id", "timestamp", "revenue",
                "conversion_type")]),
    "mart_dashboard_suite": ("rpt_marketing_dashboard", [
        ("table_row_count_to_be_greater_than", None, "> 0"), *_not_null("date", "channel"),
        _outside("spend_euros", 0), _outside("revenue_euros", 0), _outside("ctr_pct", 0, 100),
        _outside("conversion_rate_pct", 0, 100), *_exist("date", "channel", "spend_euros", "revenue_euros")]),
}
_COST = ("cost_is_positive", "cost_micros", "cost_micros <= 0")
_INTEGRITY = " UNION ALL ".join(_suite(*s) for s in (
    ("impression_cost_suite", "raw_ad_impressions", [_COST]),
    ("click_integrity_suite", "raw_clicks", [
        ("clicks_reference_valid_impressions", "impression_id",
         "NOT EXISTS (SELECT 1 FROM raw_ad_impressions p WHERE p.impression_id = raw_clicks.impression_id)"), _COST]),
    ("conversion_integrity_suite", "raw_conversions", [
        ("conversions_reference_valid_clicks", "click_id",
         "NOT EXISTS (SELECT 1 FROM raw_clicks p WHERE p.click_id = raw_conversions.click_id)")]),
))


def _named_suite(name: str, source: str | None = None) -> str:
    return _suite(name, *_SUITES[name], source)


_ALL_RAW = " UNION ALL ".join(f"({_named_suite(n)})" for n in _SUITES if n.startswith("raw"))

QUERIES |= {
    "quality_raw_impressions": _named_suite("raw_impressions_suite"),
    "quality_raw_clicks": _named_suite("raw_clicks_suite"),
    "quality_raw_conversions": _named_suite("raw_conversions_suite"),
    "quality_mart": _named_suite("mart_dashboard_suite", "dash"),
    "quality_integrity": _INTEGRITY,
    "quality_sampled_clicks": "SELECT * FROM (" + _suite("raw_clicks_suite", "raw_clicks", [
        c if c[0] != "column_values_to_be_unique" else _repeated("click_id", "sampled_clicks")
        for c in _SUITES["raw_clicks_suite"][1]], "sampled_clicks") + ") WHERE check_no > 1",
    "quality_suite_statistics": f"""
SELECT suite_name, dataset, count(*) AS evaluated_expectations,
       count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       {rnd('CAST(count(*) FILTER (WHERE success) * 100 AS DOUBLE) / count(*)', 1)} AS success_percent,
       bool_and(success) AS success FROM ({_ALL_RAW}) GROUP BY 1, 2""",
    "quality_totals": f"""
SELECT count(*) AS checks, count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed,
       bool_and(success) AS all_passed FROM ({_ALL_RAW})""",
    "fk_orphans_clicks": """
SELECT impression_id, count(*) AS n FROM raw_clicks
WHERE impression_id NOT IN (SELECT impression_id FROM raw_ad_impressions) GROUP BY 1""",
    "fk_orphan_examples": """
SELECT impression_id, count(*) AS n FROM raw_clicks
WHERE impression_id NOT IN (SELECT impression_id FROM raw_ad_impressions) GROUP BY 1 ORDER BY 1 LIMIT 10""",
    "fk_orphans_conversions": """
SELECT click_id, count(*) AS n FROM raw_conversions
WHERE click_id NOT IN (SELECT click_id FROM raw_clicks) GROUP BY 1""",
    "duplicate_click_examples": """
SELECT click_id, count(*) AS n FROM raw_clicks GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 10""",
}


def _batch_check(no: int, dataset: str, kind: str, column: str, bad: str, share: object = 1, over_all: bool = False) -> str:
    base = "n" if over_all else "(n - missing)"
    return f"""
SELECT {no} AS check_no, batch, 'expect_column_values_to_{kind}' AS expectation, '{column}' AS col, n, bad,
       ifnull(({base} - bad) / nullif(CAST({base} AS DOUBLE), 0e0) >= {share}, true) AS success
FROM (SELECT date_trunc('week', timestamp) AS batch, count(*) AS n, count(*) - count({column}) AS missing,
             count(*) FILTER (WHERE {bad}) AS bad FROM {dataset} GROUP BY 1)"""


def _batch_rows(dataset: str, floor: int) -> str:
    return f"""
SELECT 1 AS check_no, date_trunc('week', timestamp) AS batch, 'expect_table_row_count_to_be_between' AS expectation,
       '' AS col, count(*) AS n, NULL AS bad, count(*) >= {floor} AS success FROM {dataset} GROUP BY 2"""


def _batch_unique(no: int, dataset: str, column: str) -> str:
    # Uniqueness is within the batch.
    marked = (f"(SELECT *, count(*) OVER (PARTITION BY date_trunc('week', timestamp), {column}) AS copies "
              f"FROM {dataset})")
    return _batch_check(no, marked, "be_unique", column, "copies > 1")


def _batch_suite(name: str, dataset: str, checks: list[str]) -> str:
    return (f"SELECT '{name}' AS suite_name, '{dataset}' AS dataset, * FROM ("
            + " UNION ALL ".join(f"({c})" for c in checks) + ")")


PARTS["batch_checks"] = " UNION ALL ".join([
    _batch_suite("click_batch_suite", "raw_clicks", [
        _batch_rows("raw_clicks", 20),
        _batch_check(2, "raw_clicks", "not_be_null", "click_id", "click_id IS NULL", over_all=True),
        _batch_check(3, "raw_clicks", "not_be_null", "impression_id", "impression_id IS NULL", over_all=True),
        _batch_unique(4, "raw_clicks", "click_id"),
        _batch_check(5, "raw_clicks", "be_between", "cost_micros", "cost_micros NOT BETWEEN 0 AND 490000", 0.97)]),
    _batch_suite("conversion_batch_suite", "raw_conversions", [
        _batch_rows("raw_conversions", 5),
        _batch_check(2, "raw_conversions", "not_be_null", "conversion_id", "conversion_id IS NULL", over_all=True),
        _batch_check(3, "raw_conversions", "not_be_null", "revenue", "revenue IS NULL", over_all=True),
        _batch_unique(4, "raw_conversions", "conversion_id"),
        _batch_check(5, "raw_conversions", "be_between", "revenue", "revenue NOT BETWEEN 0 AND 1950")]),
])
PARTS["runs"] = """
SELECT batch AS timestamp, suite_name, dataset, bool_and(success) AS success, max(n) AS row_count,
       count(*) AS total_expectations, count(*) FILTER (WHERE success) AS passed,
       count(*) FILTER (WHERE NOT success) AS failed FROM batch_checks GROUP BY 1, 2, 3"""


def _volumes(back: int) -> str:
    weekly = " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, date_trunc('week', timestamp) AS timestamp, count(*) AS row_count FROM {d} GROUP BY 2"
        for d in ("raw_ad_impressions", "raw_clicks", "raw_conversions"))
    change = rnd("CAST((row_count - before) * 100 AS DOUBLE) / CAST(before AS DOUBLE)", 1)
    return f"""
SELECT dataset, timestamp, row_count, {big('8')} AS expected_min, CAST(NULL AS BIGINT) AS expected_max,
       {change} AS change_from_previous_pct, ifnull(abs({change}) > 50, false) AS anomaly_detected,
       if(row_count >= 8, 'ok', 'warning') AS status
FROM (SELECT *, lag(row_count, {back}) OVER (PARTITION BY dataset ORDER BY timestamp) AS before FROM ({weekly}))"""


PARTS["volumes"] = _volumes(1)
PARTS["volumes2"] = _volumes(2)
_NULL_COLUMNS = {
    "raw_ad_impressions": "impression_id campaign_id channel platform timestamp device_type country cost_micros",
    "raw_clicks": "click_id impression_id campaign_id channel platform timestamp device_type country cost_micros",
    "raw_conversions": "conversion_id click_id campaign_id customer_id timestamp revenue conversion_type",
}
PARTS["null_rates"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, '{c}' AS \"column\", count(*) AS total_rows, count(*) - count({c}) AS null_count FROM {d}"
    for d, cs in _NULL_COLUMNS.items() for c in cs.split())


def _daily_schemas(dataset: str, columns: list[str]) -> str:
    """Per day: which columns hold a value, which come, go, or turn whole or fractional; timestamp is always there."""
    kinds = {c: f"CASE WHEN count({c}) = 0 THEN NULL ELSE 'same' END" for c in columns}
    if "revenue" in kinds:
        kinds["revenue"] = """CASE WHEN count(revenue) = 0 THEN NULL
                                   WHEN count(*) FILTER (WHERE revenue <> floor(revenue)) > 0 THEN 'part' ELSE 'whole' END"""
    days = ", ".join(f"{kind} AS {c}" for c, kind in kinds.items())
    before = ", ".join(f"lag({c}) OVER (ORDER BY day) AS was_{c}" for c in columns)

    def names(condition: str) -> str:
        cases = ", ".join(f"CASE WHEN known AND {condition.format(c)} THEN '{c}' END" for c in sorted(columns))
        return f"concat_ws(',', {cases})"

    held = " + ".join(f"CAST({c} IS NOT NULL AS BIGINT)" for c in columns)
    return f"""
SELECT '{dataset}' AS dataset, CAST(day AS TIMESTAMP) AS timestamp, {big(held + ' + 1')} AS column_count,
       {names('{0} IS NOT NULL AND was_{0} IS NULL')} AS added, {names('{0} IS NULL AND was_{0} IS NOT NULL')} AS removed,
       {names('{0} <> was_{0}')} AS type_changed
FROM (SELECT *, lag(true) OVER (ORDER BY day) IS NOT NULL AS known, {before}
      FROM (SELECT date_trunc('day', timestamp) AS day, {days}
            FROM {dataset} GROUP BY 1))"""


PARTS["schemas"] = "SELECT *, if(added || removed || type_changed = '', 'ok', 'drifted') AS status FROM (" + " UNION ALL ".join(
    f"({_daily_schemas(d, cs.replace(' timestamp', '').split())})" for d, cs in _NULL_COLUMNS.items()) + ")"
_NULL_PCT = rnd("CAST(null_count * 100 AS DOUBLE) / CAST(total_rows AS DOUBLE)")
PARTS["fresh"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, max(timestamp) AS latest_data_timestamp FROM {d}" for d in _NULL_COLUMNS)
_STALE = "(CAST(epoch_us(TIMESTAMP '2001-11-06') - epoch_us(latest_data_timestamp) AS DOUBLE) / 6e7)"
_FRESH_STATUS = f"CASE WHEN {_STALE} <= 2160 THEN 'fresh' WHEN {_STALE} <= 4320 THEN 'stale' ELSE 'critical' END"
_RUN_TEXT = f"* REPLACE ({txt('timestamp')})"
_COUNTED = {
    "stg_ad_impressions": "imp", "stg_clicks": "clk0", "stg_conversions": "cv0", "stg_campaigns": "camp",
    "int_campaign_performance": "perf", "rpt_marketing_dashboard": "dash", "rpt_channel_roi": "roi",
    "rpt_customer_acquisition": "acq",
}

QUERIES |= {
    "validation_runs": f"SELECT {_RUN_TEXT} FROM runs",
    "recent_runs": f"""
SELECT {_RUN_TEXT} FROM (SELECT * FROM runs WHERE suite_name = 'click_batch_suite' AND timestamp >= '2000-01-01'
                         ORDER BY timestamp DESC LIMIT 25)""",
    "pass_rate_trend": f"""
SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date,
       {rnd('CAST(count(*) FILTER (WHERE success) * 100 AS DOUBLE) / count(*)', 1)} AS pass_rate,
       count(*) AS total_runs, count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed,
       if({rnd('CAST(count(*) FILTER (WHERE success) * 100 AS DOUBLE) / count(*)', 1)} >= 95, 'met', 'missed') AS target_status
FROM runs WHERE timestamp >= TIMESTAMP '2000-06-30 12:00:00' GROUP BY 1""",
    "latest_by_suite": f"""
SELECT {_RUN_TEXT} FROM runs r WHERE timestamp = (SELECT max(timestamp) FROM runs x WHERE x.suite_name = r.suite_name)""",
    "failure_details": """
SELECT CAST(timestamp AS VARCHAR) AS timestamp, suite_name AS suite, dataset, expectation, col AS "column",
       CAST(bad AS VARCHAR) AS unexpected
FROM (SELECT timestamp, c.* FROM batch_checks c
      JOIN (SELECT timestamp, suite_name FROM runs ORDER BY timestamp DESC, suite_name LIMIT 20) r
           ON c.batch = r.timestamp AND c.suite_name = r.suite_name
      WHERE NOT success ORDER BY timestamp DESC, c.suite_name, check_no LIMIT 20)""",
    "volume_change": f"SELECT {_RUN_TEXT} FROM volumes",
    "volume_change_two_runs_back": f"SELECT {_RUN_TEXT} FROM volumes2",
    "volume_anomalies": f"SELECT {_RUN_TEXT} FROM volumes WHERE anomaly_detected",
    "freshness": f"""
SELECT dataset, '2001-11-06 00:00:00' AS timestamp, {txt('latest_data_timestamp')},
       {rnd(_STALE, 1)} AS staleness_minutes, {big('1440')} AS expected_interval_minutes, {_FRESH_STATUS} AS status FROM fresh""",
    "schema_drift": f"SELECT {_RUN_TEXT} FROM schemas",
    "null_rates": f"SELECT *, {_NULL_PCT} AS null_rate_pct, {_NULL_PCT} > 5 AS flagged FROM null_rates",
    "completeness": f"""
SELECT dataset, {big('sum(total_rows)')} AS cells, {big('sum(null_count)')} AS null_cells,
       {rnd("CAST(sum(total_rows) - sum(null_count) AS DOUBLE) * 1e2 / CAST(sum(total_rows) AS DOUBLE)", 4)} AS completeness_pct,
       CASE WHEN sum(null_count) > 0 THEN first("column" ORDER BY null_count DESC, "column") END AS worst_column
FROM null_rates GROUP BY 1""",
    "null_rate_records": f"""
SELECT dataset, max(total_rows) AS total_rows, 5e0 AS threshold_pct,
       ifnull(string_agg("column", ',' ORDER BY "column") FILTER (WHERE {_NULL_PCT} > 5), '') AS flagged_columns,
       if(bool_or({_NULL_PCT} > 5), 'warning', 'ok') AS status FROM null_rates GROUP BY 1""",
    "health_summary": f"""
SELECT dataset, CASE WHEN freshness = 'critical' THEN 'critical'
                     WHEN freshness = 'stale' OR volume = 'warning' OR nulls = 'warning' OR schema = 'drifted' THEN 'warning'
                     ELSE 'healthy' END AS overall, freshness, volume, schema, nulls
FROM (SELECT dataset, {_FRESH_STATUS} AS freshness FROM fresh)
JOIN (SELECT dataset, arg_max(status, timestamp) AS volume FROM volumes GROUP BY 1) USING (dataset)
JOIN (SELECT dataset, arg_max(status, timestamp) AS schema FROM schemas GROUP BY 1) USING (dataset)
JOIN (SELECT dataset, if(bool_or({_NULL_PCT} > 5), 'warning', 'ok') AS nulls FROM null_rates GROUP BY 1) USING (dataset)""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS row_count FROM {part}" for name, part in _COUNTED.items())
    + f""" UNION ALL SELECT 'int_attribution', (SELECT 2 * count(DISTINCT conversion_id) FROM journey)
       + (SELECT count(DISTINCT ({_TOUCH_GROUP})) FROM journey)""",
}

_LAYER = {**dict.fromkeys(_COUNTED, "analytics_marketing"), **dict.fromkeys((n for n in _COUNTED if n.startswith("stg")), "staging_marketing")}
QUERIES |= {
    "warehouse_build": " UNION ALL ".join(
        [f"SELECT 'raw_marketing' AS layer, '{n}' AS dataset, count(*) AS row_count FROM {n}"
         for n in ("raw_ad_impressions", "raw_clicks", "raw_conversions", "raw_campaigns")]
        + [f"SELECT '{_LAYER[n]}', '{n}', count(*) FROM {part}" for n, part in _COUNTED.items()])
    + f""" UNION ALL SELECT 'analytics_marketing', 'int_attribution', (SELECT 2 * count(DISTINCT conversion_id) FROM journey)
       + (SELECT count(DISTINCT ({_TOUCH_GROUP})) FROM journey)""",
    "csv_rejects": f"""
SELECT conversion_id, click_id, campaign_id, CASE WHEN customer_id NOT LIKE '%7' THEN customer_id END AS customer_id, {txt('timestamp')},
       CASE WHEN conversion_type LIKE ' %' THEN 'n/a' ELSE CAST(revenue AS VARCHAR) END AS revenue, conversion_type,
       CAST(NULL AS VARCHAR) AS malformed_line,
       concat_ws('; ', CASE WHEN customer_id LIKE '%7' THEN 'no customer_id' END, CASE WHEN conversion_type LIKE ' %' THEN 'revenue is no double' END) AS reason
FROM raw_conversions WHERE conversion_type LIKE ' %' OR customer_id LIKE '%7'""",
    "csv_strict": f"SELECT {_RUN_TEXT} FROM raw_conversions",
    "conversions_between": f"""
SELECT {_RUN_TEXT} FROM raw_conversions WHERE timestamp >= TIMESTAMP '1996-03-11 06:00:00' AND timestamp < TIMESTAMP '1996-05-02'""",
    "csv_load": f"SELECT {_RUN_TEXT} FROM raw_conversions WHERE conversion_type NOT LIKE ' %'",
    "partitioned_table": f"""
SELECT CAST(CAST(date_trunc('month', timestamp) AS DATE) AS VARCHAR) AS event_month, count(*) AS conversions,
       {money('revenue')} AS revenue FROM raw_conversions GROUP BY 1""",
    "run_log": f"SELECT {_RUN_TEXT} FROM runs",
    "cleanup": f"SELECT {_RUN_TEXT} FROM runs WHERE timestamp >= TIMESTAMP '1999-01-11 12:00:00'",
    "metric_log": f"""
SELECT {txt('timestamp')}, dataset, 'volume' AS metric, status, row_count, change_from_previous_pct, anomaly_detected,
       CAST(NULL AS DOUBLE) AS staleness_minutes FROM volumes
UNION ALL
SELECT '2001-11-06 00:00:00', dataset, 'freshness', {_FRESH_STATUS}, NULL, NULL, NULL, {rnd(_STALE, 1)} FROM fresh""",
}

# Two feeds tracked on two days, on the first of which the later rows had not come yet.
PARTS["early_clicks"] = "SELECT * FROM raw_clicks WHERE timestamp < TIMESTAMP '1997-01-01'"
PARTS["early_conversions"] = "SELECT * FROM raw_conversions WHERE timestamp < TIMESTAMP '1997-01-01'"
_TRACKED = [("2001-11-05 00:00:00", "raw_clicks_suite", "early_clicks"), ("2001-11-06 00:00:00", "raw_clicks_suite", "raw_clicks"),
            ("2001-11-05 00:00:00", "raw_conversions_suite", "early_conversions"),
            ("2001-11-06 00:00:00", "raw_conversions_suite", "raw_conversions")]


def _seen(at: str, name: str, source: str) -> str:
    dataset, columns = _SUITES[name][0], sorted(_NULL_COLUMNS[_SUITES[name][0]].split())
    flagged = ", ".join(f"CASE WHEN {rnd(f'CAST((count(*) - count({c})) * 100 AS DOUBLE) / count(*)')} > 5 THEN '{c}' END" for c in columns)
    nulls = " + ".join(f"(count(*) - count({c}))" for c in columns)
    return f"""SELECT TIMESTAMP '{at}' AS timestamp, '{dataset}' AS dataset, count(*) AS n, max(timestamp) AS latest,
       {big(str(len(columns)))} AS column_count, concat_ws(',', {flagged}) AS flagged, {nulls} AS nulls FROM {source}"""


def _tracked_checks(at: str, name: str, source: str) -> str:
    dataset, checks = _SUITES[name]
    own = [_repeated(c[1], source) if c[0] == "column_values_to_be_unique" else c for c in checks]
    return f"SELECT TIMESTAMP '{at}' AS timestamp, * FROM ({_suite(name, dataset, own, source)})"


PARTS["seen"] = " UNION ALL ".join(f"({_seen(*x)})" for x in _TRACKED)
PARTS["tracked_checks"] = " UNION ALL ".join(f"({_tracked_checks(*x)})" for x in _TRACKED)
PARTS["tracked_runs"] = """
SELECT timestamp, suite_name, dataset, bool_and(success) AS success, max(element_count) AS row_count,
       count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed FROM tracked_checks GROUP BY 1, 2, 3"""
_LATE = "(CAST(epoch_us(timestamp) - epoch_us(latest) AS DOUBLE) / 6e7)"
_GROWTH = rnd("CAST((n - before) * 100 AS DOUBLE) / CAST(before AS DOUBLE)", 1)
PARTS["tracked"] = f"""
SELECT timestamp, dataset, 'volume' AS metric, 'ok' AS status, n AS row_count, {_GROWTH} AS change_from_previous_pct,
       ifnull(abs({_GROWTH}) > 50, false) AS anomaly_detected, CAST(NULL AS TIMESTAMP) AS latest_data_timestamp,
       CAST(NULL AS DOUBLE) AS staleness_minutes, CAST(NULL AS BIGINT) AS column_count, CAST(NULL AS BIGINT) AS total_rows,
       '' AS flagged_columns, CAST(NULL AS BIGINT) AS null_count
FROM (SELECT *, lag(n) OVER (PARTITION BY dataset ORDER BY timestamp) AS before FROM seen)
UNION ALL
SELECT timestamp, dataset, 'schema', 'ok', NULL, NULL, NULL, NULL, NULL, column_count, NULL, '', NULL FROM seen
UNION ALL
SELECT timestamp, dataset, 'null_rates', if(flagged = '', 'ok', 'warning'), NULL, NULL, NULL, NULL, NULL, NULL, n, flagged, nulls FROM seen
UNION ALL
SELECT timestamp, dataset, 'freshness', CASE WHEN {_LATE} <= 90 THEN 'fresh' WHEN {_LATE} <= 180 THEN 'stale' ELSE 'critical' END,
       NULL, NULL, NULL, latest, {rnd(_LATE, 1)}, NULL, NULL, '', NULL FROM seen"""

QUERIES |= {
    "track_validation": f"SELECT * REPLACE ({txt('timestamp', 'latest_data_timestamp')}) FROM tracked",
    "health_bundle": f"""
SELECT 'health_summary' AS part, dataset AS name,
       CASE WHEN 'critical' IN (f, v, s, n) THEN 'critical'
            WHEN f = 'stale' OR v = 'warning' OR s = 'drifted' OR n = 'warning' THEN 'warning' ELSE 'healthy' END AS status,
       CAST(NULL AS DOUBLE) AS amount, concat_ws(' ', f, v, s, n) AS detail
FROM (SELECT dataset, max(status) FILTER (WHERE metric = 'freshness') AS f, max(status) FILTER (WHERE metric = 'volume') AS v,
             max(status) FILTER (WHERE metric = 'schema') AS s, max(status) FILTER (WHERE metric = 'null_rates') AS n
      FROM tracked WHERE timestamp = TIMESTAMP '2001-11-06' GROUP BY 1)
UNION ALL
SELECT 'latest_runs', suite_name, CAST(success AS VARCHAR), CAST(row_count AS DOUBLE),
       concat_ws(' ', CAST(timestamp AS VARCHAR), CAST(passed AS VARCHAR), CAST(failed AS VARCHAR))
FROM tracked_runs WHERE timestamp = TIMESTAMP '2001-11-06'
UNION ALL
SELECT 'pass_rate_trend', CAST(CAST(timestamp AS DATE) AS VARCHAR), NULL,
       {rnd('CAST(count(*) FILTER (WHERE success) * 100 AS DOUBLE) / count(*)', 1)},
       concat_ws(' ', CAST(count(*) FILTER (WHERE success) AS VARCHAR), CAST(count(*) AS VARCHAR)) FROM tracked_runs GROUP BY timestamp
UNION ALL
SELECT 'recent_failures', concat_ws(' ', suite_name, expectation_type, ifnull("column", '')), 'failed',
       CAST(unexpected_count AS DOUBLE), CAST(timestamp AS VARCHAR) FROM tracked_checks WHERE NOT success""",
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in QUERIES.items()}
