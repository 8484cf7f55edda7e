"""Campaigns, audiences and exposure funnels."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import campaigns as C
from aislekit.operators import lookups as J
from aislekit.plans.registry import query
from aislekit.sources.decode import parse_channels

CC = ("customers", "campaigns")
CHAN_SQL = "list_filter(list_transform(string_split(trim(k.channels), ','), lambda x: trim(x)), lambda x: x <> '')"


def camp(t):
    return t.view("campaigns").withColumn("channel_list", parse_channels(F.col("channels")))


@query("c01_audience", CC, """
SELECT k.campaign_id, c.customer_id FROM customers c JOIN campaigns k ON c.customer_segment = k.target_segment WHERE c.signup_date <= k.start_date""")
def c01(t):
    """Campaign audiences: target segment, signed up by the start."""
    return C.audience(t.view("customers"), t.view("campaigns")).select("k.campaign_id", "c.customer_id")


_CONSENT_SQL = f"""CASE WHEN len(list_filter({CHAN_SQL}, lambda x: x IN ('Email', 'SMS', 'Push Notifications'))) = 0 THEN true
  ELSE (list_contains({CHAN_SQL}, 'Email') AND coalesce(c.email_marketing_opt_in, false))
    OR (list_contains({CHAN_SQL}, 'SMS') AND coalesce(c.sms_marketing_opt_in, false))
    OR (list_contains({CHAN_SQL}, 'Push Notifications') AND coalesce(c.push_notifications_opt_in, false)) END"""


@query("c02_consent_filter", CC, f"""
SELECT k.campaign_id, c.customer_id FROM customers c JOIN campaigns k ON c.customer_segment = k.target_segment
WHERE c.signup_date <= k.start_date AND {_CONSENT_SQL}""")
def c02(t):
    """Audience members passing the channel consent rule."""
    a = C.audience(t.view("customers"), camp(t))
    return a.where(C.consent_ok(F.col("k.channel_list"))).select("k.campaign_id", "c.customer_id")


def _assign(t):
    a = C.audience(t.view("customers"), camp(t))
    a = a.where(C.consent_ok(F.col("k.channel_list"))).select("k.campaign_id", "c.customer_id", "k.is_ab_test", "k.start_date",
                                                            "k.channel_list")
    return C.ab_split(a, F.col("is_ab_test"), 50, 50, seed=17, mode="arith")


from aislekit.operators.faults import arith_u_sql  # noqa: E402
from aislekit.plans.lookups_j import page_views  # noqa: E402

_U = arith_u_sql("CAST(campaign_id AS VARCHAR) || '|' || CAST(customer_id AS VARCHAR)", 17)
ASSIGN_SQL = f"""
WITH a AS (SELECT k.campaign_id, c.customer_id, k.is_ab_test, k.start_date FROM customers c JOIN campaigns k ON c.customer_segment = k.target_segment
  WHERE c.signup_date <= k.start_date AND {_CONSENT_SQL}),
n AS (SELECT campaign_id, count(*) AS n FROM a GROUP BY 1)
SELECT a.campaign_id, a.customer_id, CASE WHEN NOT a.is_ab_test THEN 'Treatment' WHEN {_U} < 0.5 THEN 'Control' ELSE 'Treatment' END AS assignment_group,
  a.start_date AS eligible_at
FROM a JOIN n USING (campaign_id) WHERE NOT a.is_ab_test OR n.n >= 100"""


@query("c03_c04_assignments", CC, ASSIGN_SQL)
def c04(t):
    """Treatment / Control assignments (A/B by seeded hash, min sizes 50/50)."""
    return _assign(t).select("campaign_id", "customer_id", "assignment_group", "eligible_at")


@query("c05_audience_channels", CC, f"""
SELECT s.campaign_id, s.customer_id, unnest(list_filter(list_transform(string_split(trim(k.channels), ','), lambda x: trim(x)), lambda x: x <> '')) AS channel
FROM ({ASSIGN_SQL}) s JOIN campaigns k USING (campaign_id)""")
def c05(t):
    """One row per assigned customer and campaign channel."""
    return C.audience_channels(_assign(t)).select("campaign_id", "customer_id", "channel")


@query("c06_exposure_funnel", ("campaign_exposures",), """
SELECT channel, assignment_group, count(*) AS rows, count(*) FILTER (WHERE exposed) AS delivered, count(*) FILTER (WHERE opened) AS opened,
  count(*) FILTER (WHERE clicked) AS clicked, sum(CASE WHEN exposed THEN cost_per_msg END) AS cost,
  round(avg((epoch_us(opened_time) - epoch_us(exposed_time)) / 6e7), 6) AS mins_to_open,
  round(avg((epoch_us(clicked_time) - epoch_us(opened_time)) / 6e7), 6) AS mins_to_click,
  CAST(grouping(channel, assignment_group) AS INTEGER) AS "grouping"
FROM campaign_exposures GROUP BY CUBE (channel, assignment_group)""")
def c06(t):
    """Delivered / opened / clicked funnel by channel and group, with totals."""
    return C.exposure_funnel(t.view("campaign_exposures"))


@query("c06_funnel_lift", ("campaign_exposures",), """
SELECT channel, round(t, 6) AS treatment_click_rate, round(c, 6) AS control_click_rate, round(t - c, 6) AS lift FROM (
 SELECT channel, count(*) FILTER (WHERE clicked AND assignment_group = 'Treatment') / nullif(count(*) FILTER (WHERE assignment_group = 'Treatment'), 0) AS t,
   count(*) FILTER (WHERE clicked AND assignment_group = 'Control') / nullif(count(*) FILTER (WHERE assignment_group = 'Control'), 0) AS c
 FROM campaign_exposures GROUP BY 1)""")
def c06b(t):
    """Click-rate lift of Treatment over Control per channel."""
    return C.funnel_lift(t.view("campaign_exposures"))


@query("c08_channel_mix", ("campaign_exposures",), """
SELECT customer_id, list_slice(list_distinct_ordered, 1, 2) AS channels FROM (
  SELECT customer_id, list(channel ORDER BY first_seen) AS list_distinct_ordered FROM (
    SELECT customer_id, channel, min(event_id) AS first_seen FROM campaign_exposures WHERE channel IS NOT NULL GROUP BY 1, 2) GROUP BY 1)""")
def c08(t):
    """First two distinct channels each customer was reached on."""
    e = t.view("campaign_exposures").where(F.col("channel").isNotNull())
    first = e.groupBy("customer_id", "channel").agg(F.min("event_id").alias("first_seen"))
    lists = first.groupBy("customer_id").agg(F.sort_array(F.collect_list(F.struct("first_seen", "channel"))).alias("__l"))  # <= 5 channels
    return lists.select("customer_id", C.channel_mix(F.col("__l.channel"), F.lit(2)).alias("channels"))


@query("c10_exposure_counts", ("clickstreams", "products", "promotions", "bundle_items"), """
WITH e AS (SELECT c.event_id, c.session_id, c.event_timestamp, c.event_type, CAST(c.event_timestamp - INTERVAL '28' YEAR AS DATE) AS d,
  CAST(c.product_id AS VARCHAR) AS pid, p.category FROM clickstreams c LEFT JOIN products p USING (product_id)),
pp AS (SELECT DISTINCT event_id, promotion_id FROM (
 SELECT e.event_id, p.promotion_id FROM e JOIN promotions p ON p.promotion_scope = 'cart' AND d BETWEEN effective_start_date AND effective_end_date
   WHERE e.event_type IN ('Cart View', 'Checkout Start')
 UNION ALL SELECT e.event_id, p.promotion_id FROM e JOIN promotions p ON p.promotion_scope = 'category' AND p.promotion_target_id = e.category
   AND d BETWEEN effective_start_date AND effective_end_date WHERE e.event_type IN ('Category View', 'Product View')
 UNION ALL SELECT e.event_id, p.promotion_id FROM e JOIN promotions p ON p.promotion_scope = 'product' AND p.promotion_target_id = e.pid
   AND d BETWEEN effective_start_date AND effective_end_date WHERE e.event_type = 'Product View'
 UNION ALL SELECT e.event_id, p.promotion_id FROM e JOIN bundle_items bi ON CAST(bi.product_id AS VARCHAR) = e.pid
   JOIN promotions p ON p.promotion_scope = 'bundle' AND p.promotion_target_id = CAST(bi.bundle_id AS VARCHAR)
   AND d BETWEEN effective_start_date AND effective_end_date WHERE e.event_type = 'Product View')),
x AS (SELECT pp.event_id, pp.promotion_id, pr.promotion_mechanic, e.session_id, e.event_timestamp FROM pp JOIN e USING (event_id) JOIN promotions pr USING (promotion_id))
SELECT event_id, promotion_id,
  count(*) OVER (PARTITION BY session_id, promotion_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS times_seen,
  count(*) OVER (PARTITION BY session_id, promotion_mechanic ORDER BY event_timestamp, event_id, promotion_id ROWS UNBOUNDED PRECEDING) AS mechanic_seen
FROM x""")
def c10(t):
    """Times each promotion (and its mechanic) was seen so far in the session."""
    cs = t.view("clickstreams")
    pp = J.page_promotions(page_views(t), t.view("promotions"), t.view("bundle_items"))
    x = (pp.join(cs.select("event_id", "session_id", "event_timestamp"), "event_id")
         .join(t.view("promotions").select("promotion_id", "promotion_mechanic"), "promotion_id"))
    return C.exposure_counts(x).select("event_id", "promotion_id", F.col("times_seen").cast("long").alias("times_seen"),
                                       F.col("mechanic_seen").cast("long").alias("mechanic_seen"))


def _mech_sql() -> str:
    compat = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(x) for x in v)}]" for k, v in C.CHANNEL_PROMOTION_COMPATIBILITY.items())
    prim = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(x) for x in v['primary'])}]" for k, v in C.CAMPAIGN_PROMOTION_STRATEGY.items())
    sec = " ".join(f"WHEN '{k}' THEN {('[' + ', '.join(repr(x) for x in v['secondary']) + ']') if v['secondary'] else 'CAST([] AS VARCHAR[])'}"
                   for k, v in C.CAMPAIGN_PROMOTION_STRATEGY.items())
    u = arith_u_sql("campaign_id", 41)
    return f"""
WITH c AS (SELECT campaign_id, campaign_type, {CHAN_SQL} AS ch FROM campaigns k),
a AS (SELECT campaign_id, campaign_type, list_distinct(flatten(list_transform(ch, lambda x: coalesce(CASE x {compat} END, CAST([] AS VARCHAR[]))))) AS allowed FROM c),
p AS (SELECT *, list_filter(CASE campaign_type {prim} ELSE CAST([] AS VARCHAR[]) END, lambda x: list_contains(allowed, x)) AS primary_ok,
   list_filter(CASE campaign_type {sec} ELSE CAST([] AS VARCHAR[]) END, lambda x: list_contains(allowed, x)) AS secondary_ok,
   CASE WHEN campaign_type = 'Seasonal' THEN 2 ELSE 1 END + CAST(floor({u} * (CASE WHEN campaign_type = 'Seasonal' THEN 2 ELSE 2 END)) AS INTEGER) AS n FROM a)
SELECT campaign_id, list_concat(primary_ok[1:1], list_concat(secondary_ok, primary_ok[2:10])[1:greatest(n - len(primary_ok[1:1]), 0)]) AS mechanics FROM p"""


@query("b17_mechanics_for", ("campaigns",), _mech_sql())
def b17(t):
    """Promotion mechanics each campaign carries given its type and channels."""
    from aislekit.operators.faults import draw
    c = camp(t)
    return c.select("campaign_id", C.mechanics_for(F.col("campaign_type"), F.col("channel_list"),
                                                   draw(F.col("campaign_id"), 41, "arith")).alias("mechanics"))
