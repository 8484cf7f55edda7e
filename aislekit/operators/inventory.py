"""Inventory: calendars, stock ledger, sparse snapshots, stockouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislekit.functions.pricing import stock_band, stock_status
from aislekit.operators.sequence import neighbour, running_sum

# Reason key -> text of an inventory change.
CHANGE_REASONS = {
    "stockout": "Stockout event — stock zeroed",
    "pre_stockout_drain": "Anticipated stockout — proactive drawdown",
    "seasonal_restock": "Pre-seasonal restock",
    "seasonal_drop": "Post-seasonal demand drop",
    "overstocked_reduction": "Overstocked — replenishment paused",
    "overorder": "Forecasting error — over-ordered",
    "healthy_drift": "Normal healthy-band drift",
    "low_band_drift": "Low-band minor fluctuation",
    "critical_replenish": "Critical stock — replenishment triggered",
    "critical_decay": "Critical stock — operational delay, partial decay",
    "eol_drawdown": "End-of-life — replenishment stopped",
    "eol_final_restock": "End-of-life — small final restock",
    "spoilage": "Perishable spoilage / expiry loss",
}


def week_calendar(start: Column, end: Column, step_days: int = 7) -> Column:
    """Dates from start to end every ``step_days`` (array<date>)."""
    return F.sequence(F.to_date(start), F.to_date(end), F.expr(f"INTERVAL {step_days} DAYS"))


def weeks_in_life(products: DataFrame, data_end: str, week_anchor: str = "1995-01-02") -> DataFrame:
    """(product_id, week_start) for every week with week_end >= launch
    and week_start <= end of life (open end: the data end).  Weeks start on
    the anchor's weekday.  One row per product-week, so the cost is the
    output size."""
    anchor = F.lit(week_anchor).cast("date")
    launch = F.to_date("launch_date")
    stop = F.coalesce(F.to_date("discontinuation_date"), F.lit(data_end).cast("date"))
    # first week whose end (start + 6) reaches the launch
    first = F.date_add(anchor, (F.floor(F.datediff(launch, anchor) / 7) * 7).cast("int"))
    return products.where(launch <= stop).select(
        "product_id", F.explode(F.sequence(first, stop, F.expr("INTERVAL 7 DAYS"))).alias("week_start"))


def stockout_weeks(stockouts: DataFrame, week_anchor: str = "1995-01-02") -> DataFrame:
    """(store_id, product_id, week_start) of every week a stockout
    window overlaps (closed ends).  Each window is exploded into the weeks
    it touches, so the join to a calendar is an equi join."""
    anchor = F.lit(week_anchor).cast("date")
    s = F.to_date("stockout_start_date")
    e = F.coalesce(F.to_date("stockout_end_date"), s)
    first = F.date_add(anchor, (F.floor(F.datediff(s, anchor) / 7) * 7).cast("int"))
    return (stockouts.select("store_id", "product_id",
                             F.explode(F.sequence(first, F.greatest(first, e), F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
            .distinct())


def week_stockout_flags(calendar: DataFrame, stockouts: DataFrame, week_anchor: str = "1995-01-02") -> DataFrame:
    """Calendar rows + stockout_this_week / stockout_next_week flags."""
    sw = stockout_weeks(stockouts, week_anchor).withColumn("__f", F.lit(True))
    nxt = sw.select("store_id", "product_id", F.date_sub("week_start", 7).alias("week_start"),
                    F.lit(True).alias("__n"))
    return (calendar.join(sw, ["store_id", "product_id", "week_start"], "left")
            .join(nxt, ["store_id", "product_id", "week_start"], "left")
            .select(*calendar.columns, F.coalesce("__f", F.lit(False)).alias("stockout_this_week"),
                    F.coalesce("__n", F.lit(False)).alias("stockout_next_week")))


def opening_balances(events: DataFrame, keys=("store_id", "product_id"), ts: str = "event_timestamp") -> DataFrame:
    """The first event row of each key (grouped min, no window)."""
    cols = [c for c in events.columns if c not in keys]
    first = events.groupBy(*keys).agg(F.min(F.struct(F.col(ts).alias("__ts"), *[F.col(c) for c in cols if c != ts])).alias("__f"))
    return first.select(*keys, F.col("__f.__ts").alias(ts), *[F.col(f"__f.{c}").alias(c) for c in cols if c != ts])


def first_event_per_time(events: DataFrame, keys=("store_id", "product_id", "event_timestamp"), tie: str = "delta") -> DataFrame:
    """One event per (store, product, ts): the first by ``tie``."""
    cols = [c for c in events.columns if c not in keys]
    first = events.groupBy(*keys).agg(F.min(F.struct(F.col(tie).alias("__t"), *[F.col(c) for c in cols])).alias("__f"))
    return first.select(*keys, *[F.col(f"__f.{c}").alias(c) for c in cols])


def stock_ledger(events: DataFrame, opening: DataFrame | None = None, split: bool = True) -> DataFrame:
    """stock_after = previous stock_after + delta per (store, product)
    in time order (opening balance added when given); zero deltas are not
    emitted.  Running sum is bucketed by month, so a hot key stays
    parallel; without ``split`` (no hot key) a key is one window."""
    e = events.where(F.col("delta") != 0)
    led = running_sum(e, ["store_id", "product_id"], ["event_timestamp"], "delta", "stock_after", split=split)
    if opening is not None:
        led = (led.join(opening.select("store_id", "product_id", F.col("opening_stock")), ["store_id", "product_id"], "left")
               .withColumn("stock_after", F.col("stock_after") + F.coalesce("opening_stock", F.lit(0))).drop("opening_stock"))
    return led


def sparse_changes(ledger: DataFrame, split: bool = True) -> DataFrame:
    """Stock snapshots only where band or status differs from the
    previous row of the key (null-safe).  -> snapshot rows with band/status.
    ``split`` as for ``stock_ledger``."""
    d = ledger.withColumn("stock_band", stock_band(F.col("stock_after"))) \
        .withColumn("stock_status", stock_status(F.col("stock_band")))
    n = neighbour(d, ["store_id", "product_id"], ["event_timestamp"], ["stock_band", "stock_status"], "prev", split=split)
    changed = ~(F.col("stock_band").eqNullSafe(F.col("prev_stock_band"))
                & F.col("stock_status").eqNullSafe(F.col("prev_stock_status")))
    return n.where(changed).drop("prev_stock_band", "prev_stock_status")


def policy_branch(stock: Column, days_to_eol: Column | None = None, perishable: Column | None = None) -> Column:
    """struct(branch reason key, eol, perishable) in the source's order: over
    (> 101), healthy (100..101), low (6..100), critical (1..5), below
    critical; end of life within 14 days; perishable flag."""
    branch = (F.when(stock > 101, "overstocked_reduction")
              .when((stock >= 100) & (stock <= 101), "healthy_drift")
              .when((stock >= 6) & (stock <= 100), "low_band_drift")
              .when((stock >= 1) & (stock < 6), "critical_replenish")
              .when(stock < 1, "critical_replenish"))
    eol = (days_to_eol <= 14) if days_to_eol is not None else F.lit(False)
    per = perishable if perishable is not None else F.lit(False)
    return F.struct(branch.alias("branch"), eol.alias("end_of_life"), per.alias("perishable"))


def reason_label(key: Column) -> Column:
    """Reason key -> reason text (unknown keys give null)."""
    m = F.create_map(*[F.lit(x) for kv in CHANGE_REASONS.items() for x in kv])
    return F.element_at(m, key)


def non_overlapping_windows(stockouts: DataFrame) -> DataFrame:
    """Per (store, product, year): ends clipped to 31 Dec of the start
    year, each start moved to the day after the latest earlier end, and
    windows left empty dropped.  Partitioned by key and year."""
    s = F.to_date("stockout_start_date")
    e = F.least(F.coalesce(F.to_date("stockout_end_date"), s), F.make_date(F.year(s), F.lit(12), F.lit(31)))
    d = stockouts.select("store_id", "product_id", s.alias("s"), e.alias("e"), F.year(s).alias("yr"))
    w = Window.partitionBy("store_id", "product_id", "yr").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__prev_end", F.max("e").over(w))
    ns = F.when(F.col("__prev_end").isNull(), F.col("s")).otherwise(F.greatest(F.col("s"), F.date_add("__prev_end", 1)))
    return (d.select("store_id", "product_id", ns.alias("stockout_start_date"), F.col("e").alias("stockout_end_date"))
            .where(F.col("stockout_start_date") <= F.col("stockout_end_date")))
