"""Cross-table output checks (X-*): each returns the violating rows.

A check states what must hold (the source's assertion); a row violates it
when the statement is not true, with null counting as not true (as a
pandas comparison with NaN is False).  All row checks of one table can
run in ONE aggregate (``row_check_counts``); set checks are a grouped
count, a key window, or an equi join with a range residual.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislekit.functions.pricing import STOCK_STATUSES
from aislekit.operators.intervals import point_in_interval_join
from aislekit.operators.sequence import neighbour, running_max

DEFAULT_NOW = "2025-01-01 00:00:00"
DIGITAL_TYPES = ["Online Only", "Omnichannel"]
EXPOSURE_ONLY_CHANNELS = ["Paid Advertisements", "In-App"]
BAND_STATUS = list(STOCK_STATUSES.items())
PHASE_RANK = {"LAUNCH": 1, "PROMO": 2, "EOL": 3}


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def violates(ok: Column) -> Column:
    return ~F.coalesce(ok, F.lit(False))


def col_or_null(df: DataFrame, c: str) -> Column:
    return F.col(c) if c in df.columns else F.lit(None)


@dataclass(frozen=True)
class RowCheck:
    name: str
    ok: object  # callable(df, params) -> Column
    applies: object = None  # callable(df, params) -> Column (rows the check looks at)


def _now(p):
    return ts(p.get("now", DEFAULT_NOW))


def _end_of_day(d: str) -> Column:
    return F.lit(d).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 SECOND")


ROW_CHECKS: dict[str, list[RowCheck]] = {
    "transactions": [
        RowCheck("x_tr01_time_within_data_window", lambda d, p: (F.col("transaction_time") <= _end_of_day(p["data_end"]))
                 & (F.col("transaction_time") >= ts(p["data_start"]))),
        RowCheck("x_tr02_time_not_in_future", lambda d, p: F.col("transaction_time") <= _now(p)),
        RowCheck("x_tr04_total_discount_value_calculation",
                 lambda d, p: (F.size("applied_promotions") != 0) | (F.col("total_discount") == 0)),
        RowCheck("x_tr05_total_discount_less_than_cart_subtotal", lambda d, p: F.col("total_discount") < F.col("cart_subtotal")),
        RowCheck("x_tr06_shipping_discount_le_shipping_fee", lambda d, p: F.col("shipping_discount") <= F.col("shipping_fee")),
        RowCheck("x_tr07_num_unique_items_le_basket_size", lambda d, p: F.col("num_unique_items") <= F.col("basket_size")),
        RowCheck("x_tr08_total_calculation", lambda d, p: F.abs(F.round("transaction_total", 2) - F.round(
            F.col("cart_subtotal") - F.col("total_discount") + F.col("shipping_fee") - F.col("shipping_discount"), 2)) < 0.02),
    ],
    "transaction_items": [
        RowCheck("x_tr09_items_item_subtotal_value_calculation",
                 lambda d, p: F.abs(F.col("item_subtotal") - F.col("unit_price") * F.col("quantity")) < 0.01),
        RowCheck("x_tr10_item_discount_less_than_item_subtotal", lambda d, p: F.col("item_discount") < F.col("item_subtotal")),
        RowCheck("x_tr11_item_final_price_calculation", lambda d, p: F.abs(
            F.round("final_item_price", 2) - F.round(F.col("item_subtotal") - F.col("item_discount"), 2)) < 0.02),
    ],
    "campaigns": [
        RowCheck("x_ca01_dates", lambda d, p: F.col("start_date") <= F.col("end_date")),
        RowCheck("x_ca02_status_aligned_with_dates", lambda d, p: (F.col("status") != "Completed") | (F.col("end_date") <= _now(p))),
    ],
    "campaign_exposures": [
        RowCheck("x_ca06_exposure_control_group_not_exposed", lambda d, p: ~F.col("exposed"),
                 lambda d, p: F.col("assignment_group") == "Control"),
        RowCheck("x_ca07_exposure_exposed_time_not_in_future", lambda d, p: F.col("exposed_time") <= _now(p),
                 lambda d, p: F.col("exposed_time").isNotNull()),
        RowCheck("x_ca08_exposure_exposed_have_exposed_time", lambda d, p: F.col("exposed_time").isNotNull() | ~F.col("exposed")),
        RowCheck("x_ca10_exposure_opened", lambda d, p: ~F.col("opened") | F.col("exposed")),
        RowCheck("x_ca11_exposure_opened_time_not_in_future", lambda d, p: F.col("opened_time") <= _now(p),
                 lambda d, p: F.col("opened_time").isNotNull()),
        RowCheck("x_ca12_exposure_opened_have_opened_time", lambda d, p: F.col("opened_time").isNotNull() | ~F.col("opened")),
        RowCheck("x_ca13_exposure_opened_time_after_exposed_time", lambda d, p: F.col("opened_time") >= F.col("exposed_time"),
                 lambda d, p: F.col("opened_time").isNotNull() & F.col("exposed_time").isNotNull()),
        RowCheck("x_ca15_exposure_clicked", lambda d, p: ~F.col("clicked") | F.col("opened")
                 | F.col("channel").isin(EXPOSURE_ONLY_CHANNELS)),
        RowCheck("x_ca16_exposure_clicked_time_not_in_future", lambda d, p: F.col("clicked_time") <= _now(p),
                 lambda d, p: F.col("clicked_time").isNotNull()),
        RowCheck("x_ca17_exposure_clicked_have_clicked_time", lambda d, p: F.col("clicked_time").isNotNull() | ~F.col("clicked")),
        RowCheck("x_ca18_exposure_clicked_time_after_opened_time", lambda d, p: F.col("clicked_time") >= F.col("opened_time"),
                 lambda d, p: F.col("clicked_time").isNotNull() & F.col("opened_time").isNotNull()),
    ],
    "promotions": [
        RowCheck("x_prom01_dates", lambda d, p: F.col("effective_start_date") <= F.col("effective_end_date")),
        RowCheck("x_prom02_percentage_discount_at_most_100", lambda d, p: F.col("promotion_value") <= 100,
                 lambda d, p: F.col("promotion_mechanic") == "percentage_discount"),
    ],
    "products": [
        RowCheck("x_prod01_cost_price_less_than_selling_price", lambda d, p: F.col("cost_price") < F.col("selling_price")),
    ],
    "product_lifecycles": [
        RowCheck("x_prod03_lifecycle_launch_date_not_in_future", lambda d, p: F.col("launch_date") <= _now(p)),
        RowCheck("x_prod04_lifecycle_discontinuation_after_launch", lambda d, p: F.col("discontinuation_date") >= F.col("launch_date"),
                 lambda d, p: F.col("discontinuation_date").isNotNull()),
        RowCheck("x_prod05_lifecycle_discontinued_has_date", lambda d, p: F.col("discontinuation_date").isNotNull()
                 | (F.col("status") != "Discontinued")),
        RowCheck("x_prod06_lifecycle_valid_from_after_launch_date", lambda d, p: F.col("valid_from") >= F.col("launch_date")),
        RowCheck("x_prod07_lifecycle_valid_to_after_valid_from", lambda d, p: F.col("valid_to") >= F.col("valid_from"),
                 lambda d, p: F.col("valid_to").isNotNull()),
        RowCheck("x_prod08_lifecycle_is_current_no_valid_to", lambda d, p: ~F.col("is_current") | F.col("valid_to").isNull()),
    ],
    "product_content_quality": [
        RowCheck("x_prod11_content_quality_image_logic", lambda d, p: (F.col("image_count") > 0) | ~F.col("has_image")),
        RowCheck("x_prod12_content_quality_description", lambda d, p: (F.col("description_length") > 0) | ~F.col("has_description")),
        RowCheck("x_prod13_content_quality_valid_from_not_in_future", lambda d, p: F.col("valid_from") <= _now(p)),
        RowCheck("x_prod14_content_quality_valid_to", lambda d, p: F.col("valid_to") >= F.col("valid_from"),
                 lambda d, p: F.col("valid_to").isNotNull()),
        RowCheck("x_prod15_content_quality_is_current", lambda d, p: ~F.col("is_current") | F.col("valid_to").isNull()),
    ],
    "product_reviews": [
        RowCheck("x_prod18_reviews_not_in_future", lambda d, p: F.col("review_date") <= _now(p)),
    ],
    "bundle_pricings": [
        RowCheck("x_bu01_pricings_dates", lambda d, p: F.col("effective_start_date") <= F.col("effective_end_date")),
        RowCheck("x_bu02_pricings_discount_value_le_bundle_price", lambda d, p: F.col("discount_value") <= F.col("bundle_price")),
    ],
    "customers": [
        RowCheck("x_cu01_dob_less_than_signup_date", lambda d, p: F.col("dob") <= F.col("signup_date"),
                 lambda d, p: F.col("dob").isNotNull() & F.col("signup_date").isNotNull()),
        RowCheck("x_cu02_dob_not_in_future", lambda d, p: F.col("dob").isNull() | (F.col("dob") <= _now(p))),
        RowCheck("x_cu03_signup_date_not_in_future", lambda d, p: F.col("signup_date").isNull() | (F.col("signup_date") <= _now(p))),
        RowCheck("x_cu04_at_least_18_at_signup", lambda d, p: F.col("signup_date").isNull() | F.col("dob").isNull()
                 | (F.col("dob") <= F.add_months("signup_date", -216))),
        RowCheck("x_cu05_online_omnichannel_customers_have_email", lambda d, p: F.col("email").isNotNull(),
                 lambda d, p: F.col("customer_type").isin(DIGITAL_TYPES)),
        RowCheck("x_cu06_online_omnichannel_customers_have_device_info",
                 lambda d, p: col_or_null(d, "device_category").isNotNull() & col_or_null(d, "device_platform").isNotNull(),
                 lambda d, p: F.col("customer_type").isin(DIGITAL_TYPES)),
        RowCheck("x_cu07_retail_walk_in_no_signup_date", lambda d, p: F.col("signup_date").isNull(),
                 lambda d, p: F.col("customer_type") == "Retail Walk-In"),
    ],
    "stockout_events": [
        RowCheck("x_st01_stockout_start_date_not_in_future", lambda d, p: F.col("stockout_start_date") <= _now(p)),
        RowCheck("x_st02_stockout_events_dates", lambda d, p: F.col("stockout_end_date") >= F.col("stockout_start_date"),
                 lambda d, p: F.col("stockout_end_date").isNotNull()),
    ],
    "stock_snapshots": [
        RowCheck("x_st04_stock_band_status_match", lambda d, p: reduce(
            lambda a, b: a | b, [(F.col("stock_band") == b) & (F.col("stock_status") == s) for b, s in BAND_STATUS])),
        RowCheck("x_st05_week_start_date_not_in_future", lambda d, p: F.col("week_start_date") <= _now(p)),
    ],
    "inventory_change_events": [
        RowCheck("x_st07_event_timestamp_not_in_future", lambda d, p: F.col("event_timestamp") <= _now(p)),
    ],
}


def find_row_check(name: str) -> tuple[str, RowCheck]:
    for table, checks in ROW_CHECKS.items():
        for c in checks:
            if c.name == name:
                return table, c
    raise KeyError(name)


def row_violations(df: DataFrame, name: str, params: dict | None = None) -> DataFrame:
    """Rows of ``df`` that violate the named row check."""
    p = dict(params or {})
    _, c = find_row_check(name)
    cond = violates(c.ok(df, p))
    if c.applies is not None:
        cond = F.coalesce(c.applies(df, p), F.lit(False)) & cond
    return df.where(cond)


def row_check_counts(df: DataFrame, table: str, params: dict | None = None) -> DataFrame:
    """Every row check of ``table`` in ONE aggregate -> (check, checked, failed)."""
    p = dict(params or {})
    checks = ROW_CHECKS[table]
    aggs = []
    for i, c in enumerate(checks):
        app = F.coalesce(c.applies(df, p), F.lit(False)) if c.applies is not None else F.lit(True)
        aggs += [F.count_if(app).alias(f"n{i}"), F.count_if(app & violates(c.ok(df, p))).alias(f"b{i}")]
    args = ", ".join(f"'{c.name}', n{i}, b{i}" for i, c in enumerate(checks))
    return df.agg(*aggs).selectExpr(f"stack({len(checks)}, {args}) AS (check_name, checked, failed)")


# ---- set checks -------------------------------------------------------------

def after_signup(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """X-tr03: transactions earlier than the customer's signup (null signup ignored)."""
    j = transactions.join(customers.select("customer_id", "signup_date"), "customer_id", "left")
    return j.where(F.col("signup_date").isNotNull() & violates(F.col("transaction_time") >= F.col("signup_date")))


def header_vs_items(transactions: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    """X-tr12 / X-tr13 / X-tr14: item sums against the header (one grouped
    aggregate of the items, one join)."""
    s = items.groupBy("transaction_id").agg(F.round(F.sum("item_subtotal"), 2).alias("items_subtotal"),
                                            F.sum("quantity").alias("items_quantity"),
                                            F.count_distinct("product_id").alias("items_unique"))
    j = s.join(transactions.select("transaction_id", "cart_subtotal", "basket_size", "num_unique_items"), "transaction_id", "left")
    return {
        "x_tr12": j.where(violates(F.abs(F.col("items_subtotal") - F.col("cart_subtotal")) < 0.02)),
        "x_tr13": j.where(violates(F.col("items_quantity") == F.col("basket_size"))),
        "x_tr14": j.where(violates(F.col("items_unique") == F.col("num_unique_items"))),
    }


def ab_groups_missing(campaigns: DataFrame, assignments: DataFrame) -> DataFrame:
    """X-ca03: A/B campaigns with assignments but without both groups."""
    g = assignments.groupBy("campaign_id").agg(F.collect_set("assignment_group").alias("groups"))  # <= 2 values
    ab = campaigns.where(F.col("is_ab_test")).select("campaign_id")
    return ab.join(g, "campaign_id").where(~(F.array_contains("groups", "Treatment") & F.array_contains("groups", "Control")))


def channel_not_listed(exposures: DataFrame, campaigns: DataFrame, channels: str = "channel_list") -> DataFrame:
    """X-ca04: exposure channel not among the campaign's channels (exposures
    of unknown campaigns are not checked)."""
    c = campaigns.select("campaign_id", F.col(channels).alias("__ch"))
    return exposures.join(c, "campaign_id").where(violates(F.array_contains("__ch", F.col("channel")))).drop("__ch")


def inconsistent_groups(exposures: DataFrame) -> DataFrame:
    """X-ca05: (campaign, customer) with more than one assignment group."""
    return (exposures.groupBy("campaign_id", "customer_id")
            .agg(F.count_distinct("assignment_group").alias("groups")).where(F.col("groups") != 1))


def outside_campaign(exposures: DataFrame, campaigns: DataFrame, time_col: str) -> DataFrame:
    """X-ca09 / 14 / 19: stamped exposures outside their campaign's window
    (an unknown campaign counts as outside)."""
    c = campaigns.select("campaign_id", F.col("start_date").alias("__s"), F.col("end_date").alias("__e"))
    j = exposures.where(F.col(time_col).isNotNull()).join(c, "campaign_id", "left")
    return j.where(violates((F.col(time_col) >= F.col("__s")) & (F.col(time_col) <= F.col("__e")))).drop("__s", "__e")


def unknown_target(promotions: DataFrame, targets: DataFrame, target_col: str, where: Column) -> DataFrame:
    """X-prom03 / X-prom04: promotion targets absent from the target table."""
    t = targets.select(F.col(target_col).cast("string").alias("__t")).distinct()
    return promotions.where(where).join(t, F.col("promotion_target_id") == F.col("__t"), "left_anti")


def current_count_not_one(versions: DataFrame, key: str = "product_id") -> DataFrame:
    """X-prod09 / X-prod16: keys whose number of current rows is not 1
    (keys with none are reported too)."""
    return versions.groupBy(key).agg(F.count_if(F.col("is_current")).alias("current_rows")).where(F.col("current_rows") != 1)


def overlapping_validity(versions: DataFrame, key: str, start: str, end: str, strict: bool = False,
                         tie: str | None = None) -> DataFrame:
    """X-prod10 / X-bu03 / X-st03: rows whose end passes the next row's
    start within the key (``strict``: end must be before the next start)."""
    order = [start] + ([tie] if tie else [])
    n = neighbour(versions, [key] if isinstance(key, str) else list(key), order, [start], "next")
    nxt = F.col(f"next_{start}")
    ok = (F.col(end) < nxt) if strict else (F.col(end) <= nxt)
    cond = nxt.isNotNull() & F.col(end).isNotNull() & violates(ok) if not strict else nxt.isNotNull() & violates(ok)
    return n.where(cond)


def gaps_between_phases(pricings: DataFrame) -> DataFrame:
    """X-bu04: phase end + 1 day != next phase start."""
    n = neighbour(pricings, ["bundle_id"], ["effective_start_date", "bundle_pricing_id"], ["effective_start_date"], "next")
    return n.where(F.col("next_effective_start_date").isNotNull()
                   & violates(F.date_add("effective_end_date", 1) == F.col("next_effective_start_date")))


def launch_not_first(pricings: DataFrame) -> DataFrame:
    """X-bu05: bundles whose earliest phase is not LAUNCH (grouped min)."""
    f = pricings.groupBy("bundle_id").agg(F.min(F.struct("effective_start_date", "bundle_pricing_id", "pricing_phase")).alias("__f"))
    return f.where(F.col("__f.pricing_phase") != "LAUNCH").select("bundle_id", F.col("__f.pricing_phase").alias("first_phase"))


def phases_out_of_order(pricings: DataFrame) -> DataFrame:
    """X-bu06: a phase that ranks below the phase before it by start date
    (LAUNCH < PROMO < EOL)."""
    m = F.create_map(*[F.lit(x) for kv in PHASE_RANK.items() for x in kv])
    d = pricings.withColumn("__r", F.element_at(m, F.col("pricing_phase")))
    n = neighbour(d, ["bundle_id"], ["effective_start_date", "bundle_pricing_id"], ["__r"], "prev")
    return n.where(F.col("prev___r").isNotNull() & violates(F.col("__r") >= F.col("prev___r"))).drop("__r", "prev___r")


def tier_score_overlap(content: DataFrame) -> DataFrame:
    """X-prod17: one row when min score of Excellent <= max score of Poor."""
    a = content.agg(F.min(F.when(F.col("quality_tier") == "Excellent", F.col("image_quality_score"))).alias("excellent_min"),
                    F.max(F.when(F.col("quality_tier") == "Poor", F.col("image_quality_score"))).alias("poor_max"))
    return a.where(F.col("excellent_min").isNotNull() & F.col("poor_max").isNotNull() & ~(F.col("excellent_min") > F.col("poor_max")))


def in_stockout_window(rows: DataFrame, stockouts: DataFrame, at: str) -> DataFrame:
    """Rows of (store, product, ``at``) falling inside a stockout window of
    the same key (closed ends, null end never holds), once per window.

    Rows are stabbed first: window starts and rows stand in one order of time,
    the greatest end so far is carried along, and a row lies in some window
    just if that end isn't before it.  Only those rows meet windows, on the key
    and the month, so a key with many windows isn't paired with all its rows.
    """
    key = ["store_id", "product_id"]
    s = stockouts.where(F.col("stockout_end_date").isNotNull()).select(
        *key, F.col("stockout_start_date").alias("__start"), F.col("stockout_end_date").alias("__end"))
    moment = lambda c: F.col(c).cast("timestamp_ntz")
    starts = s.select(*key, moment("__start").alias("__at"), F.lit(0).alias("__side"), moment("__end").alias("__until"),
                      *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name not in key])
    both = starts.unionByName(rows.withColumns({"__at": moment(at), "__side": F.lit(1), "__until": F.lit(None).cast("timestamp_ntz")}))
    seen = running_max(both, key, ["__at", "__side"], "__until", "__far")
    hit = seen.where((F.col("__side") == 1) & (F.col("__far") >= F.col("__at"))).select(*rows.columns)
    return point_in_interval_join(hit, at, s, "__start", "__end", keys=key)


def snapshot_not_out_of_stock(snapshots: DataFrame, stockouts: DataFrame) -> DataFrame:
    """X-st06: snapshots inside a stockout window that are not Out of Stock."""
    wrong = snapshots.where(violates(F.col("stock_status") == "Out of Stock"))
    return in_stockout_window(wrong, stockouts, "week_start_date")


def ledger_inconsistent(ledger: DataFrame, split: bool = True) -> DataFrame:
    """X-st08: previous stock_after + delta != stock_after; ``split`` as for ``neighbour``."""
    n = neighbour(ledger, ["store_id", "product_id"], ["event_timestamp"], ["stock_after"], "prev", split=split)
    return n.where(F.col("prev_stock_after").isNotNull()
                   & violates(F.col("prev_stock_after") + F.col("delta") == F.col("stock_after")))


def stock_not_zero_in_stockout(ledger: DataFrame, stockouts: DataFrame) -> DataFrame:
    """X-st09: ledger events inside a stockout window with stock or a
    positive delta."""
    wrong = ledger.where(violates(F.col("stock_after") == 0) | violates(F.col("delta") <= 0))
    return in_stockout_window(wrong, stockouts, "event_timestamp")


def content_versions(content: DataFrame) -> DataFrame:
    """Content rows with valid_to (next version's start) and is_current."""
    n = neighbour(content, ["product_id"], ["valid_from", "content_version_id"], ["valid_from"], "next")
    return n.withColumnRenamed("next_valid_from", "valid_to").withColumn("is_current", F.col("valid_to").isNull())


def campaign_status(start: Column, end: Column, now: str = DEFAULT_NOW) -> Column:
    """Campaign status from its window and ``now``: Planned, Active, Completed."""
    n = ts(now)
    return F.when(start > n, "Planned").when(end < n, "Completed").otherwise("Active")
