"""X-*: output checks, each returning its violating rows (keys)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislekit.operators import checks as X
from aislekit.plans.basket_b import priced
from aislekit.plans.derived import hot_stock, ledger, lifecycles, snapshots
from aislekit.plans.registry import query
from aislekit.plans.sql_basket import CHAIN, VIEWS as BASKET_VIEWS
from aislekit.plans.sql_common import LEDGER, LIFECYCLES, SNAPSHOTS
from aislekit.sources.decode import parse_channels

PARAMS = {"now": X.DEFAULT_NOW, "data_start": "1995-01-01", "data_end": "2000-12-31"}
NOW = f"TIMESTAMP '{X.DEFAULT_NOW}'"


def campaigns_x(t):
    c = t.view("campaigns")
    return c.select("*", X.campaign_status(F.col("start_date"), F.col("end_date")).alias("status"),
                    parse_channels(F.col("channels")).alias("channel_list"))


def content_x(t):
    return X.content_versions(t.view("product_content_quality"))


def snapshots_x(t):
    return snapshots(t).withColumn("week_start_date", F.to_date(F.date_trunc("week", "event_timestamp")))


SOURCES = {
    "transactions": (lambda t: priced(t)["transactions"], ["transaction_id"], "hdr"),
    "transaction_items": (lambda t: priced(t)["items"], ["transaction_id", "product_id"], "items"),
    "campaigns": (campaigns_x, ["campaign_id"], "campaigns_x"),
    "campaign_exposures": (lambda t: t.view("campaign_exposures"), ["event_id"], "campaign_exposures"),
    "promotions": (lambda t: t.view("promotions"), ["promotion_id"], "promotions"),
    "products": (lambda t: t.view("products"), ["product_id"], "products"),
    "product_lifecycles": (lifecycles, ["product_id", "valid_from"], "pl"),
    "product_content_quality": (content_x, ["content_version_id"], "pcq_v"),
    "product_reviews": (lambda t: t.view("product_reviews"), ["review_id"], "product_reviews"),
    "bundle_pricings": (lambda t: t.view("bundle_pricings"), ["bundle_pricing_id"], "bundle_pricings"),
    "customers": (lambda t: t.view("customers"), ["customer_id"], "customers"),
    "stockout_events": (lambda t: t.view("stockout_events"), ["store_id", "product_id", "stockout_start_date"], "stockout_events"),
    "stock_snapshots": (snapshots_x, ["store_id", "product_id", "event_timestamp"], "snaps_w"),
    "inventory_change_events": (ledger, ["store_id", "product_id", "event_timestamp"], "ledger"),
}

CAMPAIGNS_X_SQL = f"""SELECT *, CASE WHEN start_date > {NOW} THEN 'Planned' WHEN end_date < {NOW} THEN 'Completed' ELSE 'Active' END AS status,
  list_filter(list_transform(string_split(trim(channels), ','), lambda x: trim(x)), lambda x: x <> '') AS channel_list FROM campaigns"""
PCQ_SQL = """SELECT *, lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from, content_version_id) AS valid_to,
  lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from, content_version_id) IS NULL AS is_current FROM product_content_quality"""
SNAPS_W_SQL = "SELECT *, CAST(date_trunc('week', event_timestamp) AS DATE) AS week_start_date FROM snaps"

# per source: (adapter views, extra CTEs) the oracle needs
SQL_SOURCES = {
    "hdr": (BASKET_VIEWS, None), "items": (BASKET_VIEWS, None),
    "campaigns_x": (("campaigns",), {"campaigns_x": CAMPAIGNS_X_SQL}),
    "campaign_exposures": (("campaign_exposures",), None), "promotions": (("promotions",), None),
    "products": (("products",), None), "pl": (("lifecycle_changes",), {"pl": LIFECYCLES}),
    "pcq_v": (("product_content_quality",), {"pcq_v": PCQ_SQL}), "product_reviews": (("product_reviews",), None),
    "bundle_pricings": (("bundle_pricings",), None), "customers": (("customers",), None),
    "stockout_events": (("stockout_events",), None),
    "snaps_w": (("inventory_change_events",), {"ledger": LEDGER, "snaps": SNAPSHOTS, "snaps_w": SNAPS_W_SQL}),
    "ledger": (("inventory_change_events",), {"ledger": LEDGER}),
}

# Oracle text of each row check: (what must hold, rows it applies to)
SQL_OK = {
    "x_tr01_time_within_data_window": ("transaction_time <= TIMESTAMP '2000-12-31 23:59:59' AND transaction_time >= TIMESTAMP '1995-01-01 00:00:00'", None),
    "x_tr02_time_not_in_future": (f"transaction_time <= {NOW}", None),
    "x_tr04_total_discount_value_calculation": ("len(applied_promotions) <> 0 OR total_discount = 0", None),
    "x_tr05_total_discount_less_than_cart_subtotal": ("total_discount < cart_subtotal", None),
    "x_tr06_shipping_discount_le_shipping_fee": ("shipping_discount <= shipping_fee", None),
    "x_tr07_num_unique_items_le_basket_size": ("num_unique_items <= basket_size", None),
    "x_tr08_total_calculation": ("abs(round(transaction_total, 2) - round(cart_subtotal - total_discount + shipping_fee - shipping_discount, 2)) < 0.02", None),
    "x_tr09_items_item_subtotal_value_calculation": ("abs(item_subtotal - unit_price * quantity) < 0.01", None),
    "x_tr10_item_discount_less_than_item_subtotal": ("item_discount < item_subtotal", None),
    "x_tr11_item_final_price_calculation": ("abs(round(final_item_price, 2) - round(item_subtotal - item_discount, 2)) < 0.02", None),
    "x_ca01_dates": ("start_date <= end_date", None),
    "x_ca02_status_aligned_with_dates": (f"status <> 'Completed' OR end_date <= {NOW}", None),
    "x_ca06_exposure_control_group_not_exposed": ("NOT exposed", "assignment_group = 'Control'"),
    "x_ca07_exposure_exposed_time_not_in_future": (f"exposed_time <= {NOW}", "exposed_time IS NOT NULL"),
    "x_ca08_exposure_exposed_have_exposed_time": ("exposed_time IS NOT NULL OR NOT exposed", None),
    "x_ca10_exposure_opened": ("NOT opened OR exposed", None),
    "x_ca11_exposure_opened_time_not_in_future": (f"opened_time <= {NOW}", "opened_time IS NOT NULL"),
    "x_ca12_exposure_opened_have_opened_time": ("opened_time IS NOT NULL OR NOT opened", None),
    "x_ca13_exposure_opened_time_after_exposed_time": ("opened_time >= exposed_time", "opened_time IS NOT NULL AND exposed_time IS NOT NULL"),
    "x_ca15_exposure_clicked": ("NOT clicked OR opened OR channel IN ('Paid Advertisements', 'In-App')", None),
    "x_ca16_exposure_clicked_time_not_in_future": (f"clicked_time <= {NOW}", "clicked_time IS NOT NULL"),
    "x_ca17_exposure_clicked_have_clicked_time": ("clicked_time IS NOT NULL OR NOT clicked", None),
    "x_ca18_exposure_clicked_time_after_opened_time": ("clicked_time >= opened_time", "clicked_time IS NOT NULL AND opened_time IS NOT NULL"),
    "x_prom01_dates": ("effective_start_date <= effective_end_date", None),
    "x_prom02_percentage_discount_at_most_100": ("promotion_value <= 100", "promotion_mechanic = 'percentage_discount'"),
    "x_prod01_cost_price_less_than_selling_price": ("cost_price < selling_price", None),
    "x_prod03_lifecycle_launch_date_not_in_future": (f"launch_date <= {NOW}", None),
    "x_prod04_lifecycle_discontinuation_after_launch": ("discontinuation_date >= launch_date", "discontinuation_date IS NOT NULL"),
    "x_prod05_lifecycle_discontinued_has_date": ("discontinuation_date IS NOT NULL OR status <> 'Discontinued'", None),
    "x_prod06_lifecycle_valid_from_after_launch_date": ("valid_from >= launch_date", None),
    "x_prod07_lifecycle_valid_to_after_valid_from": ("valid_to >= valid_from", "valid_to IS NOT NULL"),
    "x_prod08_lifecycle_is_current_no_valid_to": ("NOT is_current OR valid_to IS NULL", None),
    "x_prod11_content_quality_image_logic": ("image_count > 0 OR NOT has_image", None),
    "x_prod12_content_quality_description": ("description_length > 0 OR NOT has_description", None),
    "x_prod13_content_quality_valid_from_not_in_future": (f"valid_from <= {NOW}", None),
    "x_prod14_content_quality_valid_to": ("valid_to >= valid_from", "valid_to IS NOT NULL"),
    "x_prod15_content_quality_is_current": ("NOT is_current OR valid_to IS NULL", None),
    "x_prod18_reviews_not_in_future": (f"review_date <= {NOW}", None),
    "x_bu01_pricings_dates": ("effective_start_date <= effective_end_date", None),
    "x_bu02_pricings_discount_value_le_bundle_price": ("discount_value <= bundle_price", None),
    "x_cu01_dob_less_than_signup_date": ("dob <= signup_date", "dob IS NOT NULL AND signup_date IS NOT NULL"),
    "x_cu02_dob_not_in_future": (f"dob IS NULL OR dob <= {NOW}", None),
    "x_cu03_signup_date_not_in_future": (f"signup_date IS NULL OR signup_date <= {NOW}", None),
    "x_cu04_at_least_18_at_signup": ("signup_date IS NULL OR dob IS NULL OR dob <= signup_date - INTERVAL 216 MONTH", None),
    "x_cu05_online_omnichannel_customers_have_email": ("email IS NOT NULL", "customer_type IN ('Online Only', 'Omnichannel')"),
    "x_cu06_online_omnichannel_customers_have_device_info": ("false", "customer_type IN ('Online Only', 'Omnichannel')"),
    "x_cu07_retail_walk_in_no_signup_date": ("signup_date IS NULL", "customer_type = 'Retail Walk-In'"),
    "x_st01_stockout_start_date_not_in_future": (f"stockout_start_date <= {NOW}", None),
    "x_st02_stockout_events_dates": ("stockout_end_date >= stockout_start_date", "stockout_end_date IS NOT NULL"),
    "x_st04_stock_band_status_match": ("(stock_band = '0' AND stock_status = 'Out of Stock') OR (stock_band = '1-5' AND stock_status = 'Limited Stock')"
                                       " OR (stock_band = '6-20' AND stock_status = 'Low Stock') OR (stock_band = '21-100' AND stock_status = 'In Stock')"
                                       " OR (stock_band = '101+' AND stock_status = 'Overstocked')", None),
    "x_st05_week_start_date_not_in_future": (f"week_start_date <= {NOW}", None),
    "x_st07_event_timestamp_not_in_future": (f"event_timestamp <= {NOW}", None),
}


def _oracle(src: str, body: str):
    views, ctes = SQL_SOURCES[src]
    if src in ("hdr", "items"):
        return views, "WITH RECURSIVE " + CHAIN.strip() + "\n" + body, None
    return views, body, ctes


def _register_row_check(table: str, name: str):
    build, keys, src = SOURCES[table]
    ok, applies = SQL_OK[name]
    where = f"NOT coalesce({ok}, false)" + (f" AND coalesce({applies}, false)" if applies else "")
    views, body, ctes = _oracle(src, f"SELECT {', '.join(keys)} FROM {src} WHERE {where}")

    def fn(t, _n=name, _b=build, _k=keys):
        return X.row_violations(_b(t), _n, PARAMS).select(*_k)

    fn.__doc__ = f"Rows of {table} violating {name}."
    query(name, views, body, ctes)(fn)


for _table, _checks in X.ROW_CHECKS.items():
    for _c in _checks:
        _register_row_check(_table, _c.name)


def _all_counts_sql() -> tuple[tuple, str, dict]:
    parts = []
    views: set = set()
    ctes: dict = {}
    for table, checks in X.ROW_CHECKS.items():
        _, _, src = SOURCES[table]
        v, c = SQL_SOURCES[src]
        views |= set(v)
        ctes.update(c or {})
        for ch in checks:
            ok, applies = SQL_OK[ch.name]
            app = f"coalesce({applies}, false)" if applies else "true"
            parts.append(f"SELECT '{table}' AS table_name, '{ch.name}' AS check_name, count(*) FILTER (WHERE {app}) AS checked, "
                         f"count(*) FILTER (WHERE {app} AND NOT coalesce({ok}, false)) AS failed FROM {src}")
    return tuple(sorted(views)), "\nUNION ALL\n".join(parts), ctes


_V, _B, _C = _all_counts_sql()


@query("x_all_row_checks", _V, "WITH RECURSIVE " + CHAIN.strip() + ",\n" + ",\n".join(f"{k} AS ({v})" for k, v in _C.items()) + "\n" + _B)
def x_all(t):
    """Every row check, counted with one aggregate per table."""
    parts = [X.row_check_counts(SOURCES[table][0](t), table, PARAMS).select(F.lit(table).alias("table_name"), "*")
             for table in X.ROW_CHECKS]
    return reduce(DataFrame.unionByName, parts)


PRICED_SQL = "WITH RECURSIVE " + CHAIN.strip() + "\n"


@query("x_tr03_time_after_customer_signup", BASKET_VIEWS, PRICED_SQL + """
SELECT h.transaction_id FROM hdr h LEFT JOIN customers c USING (customer_id)
WHERE c.signup_date IS NOT NULL AND NOT coalesce(h.transaction_time >= c.signup_date, false)""")
def x_tr03(t):
    """Transactions earlier than the customer's signup."""
    return X.after_signup(priced(t)["transactions"], t.view("customers")).select("transaction_id")


def _hvi_sql(cond: str) -> str:
    return PRICED_SQL + f"""
SELECT s.transaction_id FROM (SELECT transaction_id, round(sum(item_subtotal), 2) AS items_subtotal, sum(quantity) AS items_quantity,
  count(DISTINCT product_id) AS items_unique FROM items GROUP BY 1) s LEFT JOIN hdr h USING (transaction_id)
WHERE NOT coalesce({cond}, false)"""


@query("x_tr12_items_subtotal_sums_to_cart_subtotal", BASKET_VIEWS, _hvi_sql("abs(s.items_subtotal - h.cart_subtotal) < 0.02"))
def x_tr12(t):
    """Transactions whose item subtotals do not sum to the cart subtotal."""
    p = priced(t)
    return X.header_vs_items(p["transactions"], p["items"])["x_tr12"].select("transaction_id")


@query("x_tr13_items_basket_size_matches_sum", BASKET_VIEWS, _hvi_sql("s.items_quantity = h.basket_size"))
def x_tr13(t):
    """Transactions whose item quantities do not sum to the basket size."""
    p = priced(t)
    return X.header_vs_items(p["transactions"], p["items"])["x_tr13"].select("transaction_id")


@query("x_tr14_items_num_unique_items_matches", BASKET_VIEWS, _hvi_sql("s.items_unique = h.num_unique_items"))
def x_tr14(t):
    """Transactions whose distinct item count differs from the header."""
    p = priced(t)
    return X.header_vs_items(p["transactions"], p["items"])["x_tr14"].select("transaction_id")


@query("x_ca03_ab_test_has_control_and_treatment", ("campaigns", "campaign_exposures"), """
SELECT c.campaign_id FROM campaigns c JOIN (SELECT campaign_id, list(DISTINCT assignment_group) AS g FROM campaign_exposures GROUP BY 1) a USING (campaign_id)
WHERE c.is_ab_test AND NOT (list_contains(g, 'Treatment') AND list_contains(g, 'Control'))""")
def x_ca03(t):
    """A/B campaigns with assignments lacking Treatment or Control."""
    a = t.view("campaign_exposures").select("campaign_id", "customer_id", "assignment_group")
    return X.ab_groups_missing(t.view("campaigns"), a).select("campaign_id")


@query("x_ca04_channels_match_exposures", ("campaigns", "campaign_exposures"), """
SELECT e.event_id FROM campaign_exposures e JOIN campaigns_x c USING (campaign_id) WHERE NOT coalesce(list_contains(c.channel_list, e.channel), false)""",
       {"campaigns_x": CAMPAIGNS_X_SQL})
def x_ca04(t):
    """Exposures on a channel the campaign does not list."""
    return X.channel_not_listed(t.view("campaign_exposures"), campaigns_x(t)).select("event_id")


@query("x_ca05_exposure_assignment_group_consistent", ("campaign_exposures",), """
SELECT campaign_id, customer_id, count(DISTINCT assignment_group) AS groups FROM campaign_exposures GROUP BY 1, 2 HAVING count(DISTINCT assignment_group) <> 1""")
def x_ca05(t):
    """(campaign, customer) pairs with more than one assignment group."""
    return X.inconsistent_groups(t.view("campaign_exposures"))


def _outside_sql(col: str) -> str:
    return f"""SELECT e.event_id FROM campaign_exposures e LEFT JOIN campaigns c USING (campaign_id)
WHERE e.{col} IS NOT NULL AND NOT coalesce(e.{col} >= c.start_date AND e.{col} <= c.end_date, false)"""


@query("x_ca09_exposed_time_within_campaign_dates", ("campaign_exposures", "campaigns"), _outside_sql("exposed_time"))
def x_ca09(t):
    """Exposure times outside the campaign window."""
    return X.outside_campaign(t.view("campaign_exposures"), t.view("campaigns"), "exposed_time").select("event_id")


@query("x_ca14_opened_time_within_campaign_dates", ("campaign_exposures", "campaigns"), _outside_sql("opened_time"))
def x_ca14(t):
    """Open times outside the campaign window."""
    return X.outside_campaign(t.view("campaign_exposures"), t.view("campaigns"), "opened_time").select("event_id")


@query("x_ca19_clicked_time_within_campaign_dates", ("campaign_exposures", "campaigns"), _outside_sql("clicked_time"))
def x_ca19(t):
    """Click times outside the campaign window."""
    return X.outside_campaign(t.view("campaign_exposures"), t.view("campaigns"), "clicked_time").select("event_id")


@query("x_prom03_bundle_scope_has_bundle_target", ("promotions", "bundle_items"), """
SELECT promotion_id FROM promotions WHERE promotion_mechanic = 'bundle'
  AND promotion_target_id NOT IN (SELECT DISTINCT CAST(bundle_id AS VARCHAR) FROM bundle_items)""")
def x_prom03(t):
    """Bundle promotions whose target is not a known bundle."""
    return X.unknown_target(t.view("promotions"), t.view("bundle_items"), "bundle_id",
                            F.col("promotion_mechanic") == "bundle").select("promotion_id")


@query("x_prom04_product_scope_has_product_target", ("promotions", "products"), """
SELECT promotion_id FROM promotions WHERE promotion_scope = 'product'
  AND promotion_target_id NOT IN (SELECT CAST(product_id AS VARCHAR) FROM products)""")
def x_prom04(t):
    """Product promotions whose target is not a known product."""
    return X.unknown_target(t.view("promotions"), t.view("products"), "product_id",
                            F.col("promotion_scope") == "product").select("promotion_id")


@query("x_prod09_lifecycle_exactly_one_current", ("lifecycle_changes",), """
SELECT product_id, count(*) FILTER (WHERE is_current) AS current_rows FROM pl GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1""",
       {"pl": LIFECYCLES})
def x_prod09(t):
    """Products whose lifecycle has not exactly one current row."""
    return X.current_count_not_one(lifecycles(t))


@query("x_prod10_lifecycle_non_overlapping_validity", ("lifecycle_changes",), """
SELECT product_id, valid_from FROM (SELECT *, lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from, status) AS nx FROM pl)
WHERE nx IS NOT NULL AND valid_to IS NOT NULL AND NOT coalesce(valid_to <= nx, false)""", {"pl": LIFECYCLES})
def x_prod10(t):
    """Lifecycle versions overlapping the next version."""
    return X.overlapping_validity(lifecycles(t), "product_id", "valid_from", "valid_to", tie="status").select("product_id", "valid_from")


@query("x_prod16_content_quality_exactly_one_current", ("product_content_quality",), """
SELECT product_id, count(*) FILTER (WHERE is_current) AS current_rows FROM pcq_v GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1""",
       {"pcq_v": PCQ_SQL})
def x_prod16(t):
    """Products whose content has not exactly one current version."""
    return X.current_count_not_one(content_x(t))


@query("x_prod17_content_tier_consistent_with_score", ("product_content_quality",), """
SELECT * FROM (SELECT min(image_quality_score) FILTER (WHERE quality_tier = 'Excellent') AS excellent_min,
  max(image_quality_score) FILTER (WHERE quality_tier = 'Poor') AS poor_max FROM product_content_quality)
WHERE excellent_min IS NOT NULL AND poor_max IS NOT NULL AND NOT (excellent_min > poor_max)""")
def x_prod17(t):
    """One row when the Excellent and Poor image scores overlap."""
    return X.tier_score_overlap(t.view("product_content_quality"))


@query("x_bu03_pricings_non_overlapping_dates", ("bundle_pricings",), """
SELECT bundle_pricing_id FROM (SELECT *, lead(effective_start_date) OVER (PARTITION BY bundle_id ORDER BY effective_start_date, bundle_pricing_id) AS nx FROM bundle_pricings)
WHERE nx IS NOT NULL AND NOT coalesce(effective_end_date < nx, false)""")
def x_bu03(t):
    """Bundle pricing phases overlapping the next phase."""
    return X.overlapping_validity(t.view("bundle_pricings"), "bundle_id", "effective_start_date", "effective_end_date",
                                  strict=True, tie="bundle_pricing_id").select("bundle_pricing_id")


@query("x_bu04_pricings_cover_full_window", ("bundle_pricings",), """
SELECT bundle_pricing_id FROM (SELECT *, lead(effective_start_date) OVER (PARTITION BY bundle_id ORDER BY effective_start_date, bundle_pricing_id) AS nx FROM bundle_pricings)
WHERE nx IS NOT NULL AND NOT coalesce(CAST(effective_end_date + INTERVAL 1 DAY AS DATE) = nx, false)""")
def x_bu04(t):
    """Bundle pricing phases leaving a gap before the next phase."""
    return X.gaps_between_phases(t.view("bundle_pricings")).select("bundle_pricing_id")


@query("x_bu05_pricings_launch_always_first", ("bundle_pricings",), """
SELECT bundle_id, arg_min(pricing_phase, (effective_start_date, bundle_pricing_id)) AS first_phase FROM bundle_pricings GROUP BY 1
HAVING arg_min(pricing_phase, (effective_start_date, bundle_pricing_id)) <> 'LAUNCH'""")
def x_bu05(t):
    """Bundles whose first phase is not LAUNCH."""
    return X.launch_not_first(t.view("bundle_pricings"))


@query("x_bu06_pricing_phases_ordered", ("bundle_pricings",), """
SELECT bundle_pricing_id FROM (SELECT *, lag(r) OVER (PARTITION BY bundle_id ORDER BY effective_start_date, bundle_pricing_id) AS pr FROM (
  SELECT *, CASE pricing_phase WHEN 'LAUNCH' THEN 1 WHEN 'PROMO' THEN 2 WHEN 'EOL' THEN 3 END AS r FROM bundle_pricings))
WHERE pr IS NOT NULL AND NOT coalesce(r >= pr, false)""")
def x_bu06(t):
    """Phases ranking below the previous phase by start date."""
    return X.phases_out_of_order(t.view("bundle_pricings")).select("bundle_pricing_id")


@query("x_st03_stockouts_non_overlapping", ("stockout_events",), """
SELECT store_id, product_id, stockout_start_date FROM (SELECT *, lead(stockout_start_date) OVER (PARTITION BY store_id, product_id
  ORDER BY stockout_start_date, stockout_end_date) AS nx FROM stockout_events)
WHERE nx IS NOT NULL AND stockout_end_date IS NOT NULL AND NOT coalesce(stockout_end_date <= nx, false)""")
def x_st03(t):
    """Stockouts overlapping the next stockout of the same store and product."""
    return X.overlapping_validity(t.view("stockout_events"), ["store_id", "product_id"], "stockout_start_date",
                                  "stockout_end_date", tie="stockout_end_date").select("store_id", "product_id", "stockout_start_date")


@query("x_st06_stockout_reflected_in_snapshots", ("inventory_change_events", "stockout_events"), """
SELECT s.store_id, s.product_id, s.event_timestamp, o.stockout_start_date FROM snaps_w s JOIN stockout_events o
  ON s.store_id = o.store_id AND s.product_id = o.product_id AND s.week_start_date >= o.stockout_start_date AND s.week_start_date <= o.stockout_end_date
WHERE NOT coalesce(s.stock_status = 'Out of Stock', false)""", {"ledger": LEDGER, "snaps": SNAPSHOTS, "snaps_w": SNAPS_W_SQL})
def x_st06(t):
    """Snapshots inside a stockout window that are not Out of Stock."""
    return X.snapshot_not_out_of_stock(snapshots_x(t), t.view("stockout_events")).select(
        "store_id", "product_id", "event_timestamp", F.col("__start").alias("stockout_start_date"))


@query("x_st08_delta_consistent_with_stock_after", ("inventory_change_events",), """
SELECT store_id, product_id, event_timestamp FROM (SELECT *, lag(stock_after) OVER (PARTITION BY store_id, product_id ORDER BY event_timestamp) AS ps FROM ledger)
WHERE ps IS NOT NULL AND NOT coalesce(ps + delta = stock_after, false)""", {"ledger": LEDGER})
def x_st08(t):
    """Ledger rows where previous stock + delta != stock after."""
    return X.ledger_inconsistent(ledger(t), hot_stock(t)).select("store_id", "product_id", "event_timestamp")


@query("x_st09_stockout_forces_inventory_to_zero", ("inventory_change_events", "stockout_events"), """
SELECT l.store_id, l.product_id, l.event_timestamp, o.stockout_start_date FROM ledger l JOIN stockout_events o
  ON l.store_id = o.store_id AND l.product_id = o.product_id AND l.event_timestamp >= o.stockout_start_date AND l.event_timestamp <= o.stockout_end_date
WHERE NOT coalesce(l.stock_after = 0, false) OR NOT coalesce(l.delta <= 0, false)""", {"ledger": LEDGER})
def x_st09(t):
    """Ledger events inside a stockout window with stock left or stock added."""
    return X.stock_not_zero_in_stockout(ledger(t), t.view("stockout_events")).select(
        "store_id", "product_id", "event_timestamp", F.col("__start").alias("stockout_start_date"))
