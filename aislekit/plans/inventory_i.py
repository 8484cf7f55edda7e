"""Inventory operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import inventory as I
from aislekit.plans.derived import ledger, lifecycles, snapshots
from aislekit.plans.registry import query
from aislekit.plans.sql_common import LEDGER, LIFECYCLES, SNAPSHOTS

ANCHOR = "1995-01-02"


@query("i01_week_calendar", (), """
SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 7 DAY)) AS DATE) AS week_start FROM orders""")
def i01(t):
    """Weekly calendar over the order date range."""
    r = t.orders.agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    return r.select(F.explode(I.week_calendar(F.col("s"), F.col("e"))).alias("week_start"))


@query("i03_weeks_in_life", ("lifecycle_changes",), f"""
WITH pl AS ({LIFECYCLES}),
p AS (SELECT product_id, min(launch_date) AS launch_date, max(discontinuation_date) AS discontinuation_date FROM pl GROUP BY 1)
SELECT product_id, CAST(unnest(generate_series(DATE '{ANCHOR}' + CAST(floor(datediff('day', DATE '{ANCHOR}', launch_date) / 7) * 7 AS INTEGER),
   coalesce(discontinuation_date, DATE '2001-12-31'), INTERVAL 7 DAY)) AS DATE) AS week_start
FROM p WHERE launch_date <= coalesce(discontinuation_date, DATE '2001-12-31')""")
def i03(t):
    """Product-weeks inside each product's life (launch to discontinuation)."""
    p = lifecycles(t).groupBy("product_id").agg(F.min("launch_date").alias("launch_date"),
                                                F.max("discontinuation_date").alias("discontinuation_date"))
    return I.weeks_in_life(p, "2001-12-31", ANCHOR)


@query("i04_week_stockout_flags", ("inventory_change_events", "stockout_events"), f"""
WITH cal AS (SELECT store_id, product_id, CAST(unnest(generate_series(DATE '{ANCHOR}' + CAST(floor(datediff('day', DATE '{ANCHOR}', CAST(min(event_timestamp) AS DATE)) / 7) * 7 AS INTEGER),
               CAST(max(event_timestamp) AS DATE), INTERVAL 7 DAY)) AS DATE) AS week_start FROM inventory_change_events GROUP BY 1, 2),
sw AS (SELECT DISTINCT store_id, product_id, CAST(unnest(generate_series(DATE '{ANCHOR}' + CAST(floor(datediff('day', DATE '{ANCHOR}', stockout_start_date) / 7) * 7 AS INTEGER),
               coalesce(stockout_end_date, stockout_start_date), INTERVAL 7 DAY)) AS DATE) AS week_start FROM stockout_events)
SELECT c.store_id, c.product_id, c.week_start,
  EXISTS (SELECT 1 FROM sw WHERE sw.store_id = c.store_id AND sw.product_id = c.product_id AND sw.week_start = c.week_start) AS stockout_this_week,
  EXISTS (SELECT 1 FROM sw WHERE sw.store_id = c.store_id AND sw.product_id = c.product_id AND sw.week_start = c.week_start + INTERVAL 7 DAY) AS stockout_next_week
FROM cal c""")
def i04(t):
    """Weekly calendar per (store, product) with this/next-week stockout flags."""
    ev = t.view("inventory_change_events").groupBy("store_id", "product_id").agg(
        F.min(F.to_date("event_timestamp")).alias("s"), F.max(F.to_date("event_timestamp")).alias("e"))
    anchor = F.lit(ANCHOR).cast("date")
    first = F.date_add(anchor, (F.floor(F.datediff("s", anchor) / 7) * 7).cast("int"))
    cal = ev.select("store_id", "product_id", F.explode(F.sequence(first, F.col("e"), F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
    return I.week_stockout_flags(cal, t.view("stockout_events"), ANCHOR)


@query("i05_opening_balance", ("inventory_change_events",), """
SELECT store_id, product_id, min(event_timestamp) AS event_timestamp, arg_min(delta, event_timestamp) AS delta FROM inventory_change_events GROUP BY 1, 2""")
def i05(t):
    """Opening (first) ledger row of every (store, product)."""
    return I.opening_balances(t.view("inventory_change_events"))


@query("i06_stock_ledger", ("inventory_change_events",), LEDGER)
def i06(t):
    """Stock after each non-zero change: running sum per (store, product)."""
    return ledger(t)


@query("i07_sparse_changes", ("inventory_change_events",), f"WITH ledger AS ({LEDGER}) {SNAPSHOTS}")
def i07(t):
    """Ledger rows where stock band or status changes (sparse snapshots)."""
    return snapshots(t)


@query("i08_policy_branch", ("inventory_change_events",), f"""
WITH ledger AS ({LEDGER})
SELECT store_id, product_id, event_timestamp, CASE WHEN stock_after > 101 THEN 'overstocked_reduction'
  WHEN stock_after BETWEEN 100 AND 101 THEN 'healthy_drift' WHEN stock_after BETWEEN 6 AND 100 THEN 'low_band_drift'
  WHEN stock_after >= 1 AND stock_after < 6 THEN 'critical_replenish' WHEN stock_after < 1 THEN 'critical_replenish' END AS branch
FROM ledger""")
def i08(t):
    """Replenishment policy branch of every ledger level."""
    return ledger(t).select("store_id", "product_id", "event_timestamp",
                            I.policy_branch(F.col("stock_after"))["branch"].alias("branch"))


def _reason_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in I.CHANGE_REASONS.items()) + " END"


@query("i09_reason_label", ("inventory_change_events",), f"""
WITH ledger AS ({LEDGER}),
b AS (SELECT store_id, product_id, event_timestamp, CASE WHEN stock_after > 101 THEN 'overstocked_reduction'
  WHEN stock_after BETWEEN 100 AND 101 THEN 'healthy_drift' WHEN stock_after BETWEEN 6 AND 100 THEN 'low_band_drift'
  ELSE 'critical_replenish' END AS k FROM ledger)
SELECT store_id, product_id, event_timestamp, {_reason_case('k')} AS reason FROM b""")
def i09(t):
    """Reason text of the policy branch of every ledger level."""
    b = I.policy_branch(F.col("stock_after"))["branch"]
    return ledger(t).select("store_id", "product_id", "event_timestamp", I.reason_label(b).alias("reason"))


@query("i10_first_event_per_time", (), """
SELECT l_suppkey AS store_id, l_partkey AS product_id, l_shipdate AS event_timestamp, min(l_quantity) AS delta
FROM lineitem GROUP BY 1, 2, 3""")
def i10(t):
    """One raw stock movement per (store, product, time): the smallest."""
    raw = t.lineitem.select(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id"),
                            F.col("l_shipdate").alias("event_timestamp"), F.col("l_quantity").alias("delta"))
    return I.first_event_per_time(raw)


@query("i14_non_overlapping_windows", ("stockout_events",), """
WITH d AS (SELECT store_id, product_id, stockout_start_date AS s,
   least(coalesce(stockout_end_date, stockout_start_date), make_date(year(stockout_start_date), 12, 31)) AS e, year(stockout_start_date) AS yr
   FROM stockout_events),
p AS (SELECT *, max(e) OVER (PARTITION BY store_id, product_id, yr ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM d)
SELECT store_id, product_id, CASE WHEN pe IS NULL THEN s ELSE greatest(s, CAST(pe + INTERVAL 1 DAY AS DATE)) END AS stockout_start_date, e AS stockout_end_date
FROM p WHERE (CASE WHEN pe IS NULL THEN s ELSE greatest(s, CAST(pe + INTERVAL 1 DAY AS DATE)) END) <= e""")
def i14(t):
    """Stockout windows made non-overlapping per (store, product, year)."""
    return I.non_overlapping_windows(t.view("stockout_events"))
