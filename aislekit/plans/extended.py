"""More inventory items: D08, D12, F22, F36, F39, F42, J19, V13, V14,
X-prod02, E07, E15, T03, T06."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit import functions as fx
from aislekit.operators import checks as X
from aislekit.operators import contracts as V
from aislekit.operators import faults as E
from aislekit.operators import history as D
from aislekit.operators import lookups as J
from aislekit.operators.faults import Step, arith_u_sql
from aislekit.operators.profile import ERR
from aislekit.plans.basket_b import priced
from aislekit.plans.bundles_u import WIN_SQL, _windows, bundle_type_col, BT_SQL
from aislekit.plans.checks_x import SNAPS_W_SQL, snapshots_x
from aislekit.plans.clickstream_k import ENR, enriched
from aislekit.plans.fault_plans import FUTURE_TS_SQL, future_date, money, money_sql
from aislekit.plans.registry import query
from aislekit.plans.sql_basket import CHAIN, VIEWS as BASKET_VIEWS
from aislekit.plans.sql_common import LEDGER, SNAPSHOTS

NOW = f"TIMESTAMP '{X.DEFAULT_NOW}'"
PRICED = "WITH RECURSIVE " + CHAIN.strip() + "\n"

SCRAPES_SQL = """SELECT l_suppkey AS competitor, l_partkey AS product_id, l_shipdate + to_minutes(CAST(l_linenumber * 17 AS BIGINT)) AS update_timestamp,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS scraped_price FROM lineitem"""
CPH_SQL = """SELECT s.competitor, s.product_id, s.batch_week, s.update_timestamp, s.scraped_price,
  s.scraped_price < p.selling_price * 0.9 AS has_active_promo, round(CAST(s.scraped_price AS DOUBLE) / CAST(p.selling_price AS DOUBLE), 4) AS price_index
FROM (SELECT competitor, product_id, CAST(date_trunc('week', update_timestamp) AS DATE) AS batch_week, max(update_timestamp) AS update_timestamp,
        arg_max(scraped_price, (update_timestamp, scraped_price)) AS scraped_price FROM scrapes GROUP BY 1, 2, 3) s
LEFT JOIN products p USING (product_id)"""


def scrapes(t):
    li = t.lineitem
    return li.select(F.col("l_suppkey").alias("competitor"), F.col("l_partkey").alias("product_id"),
                     (F.col("l_shipdate") + F.make_interval(mins=(F.col("l_linenumber") * 17).cast("int"))).alias("update_timestamp"),
                     (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)").alias("scraped_price"))


def price_history(t):
    key = "__cph"
    if key not in t._frames:
        t._frames[key] = D.competitor_price_history(scrapes(t), t.view("products"))
    return t._frames[key]


@query("d08_competitor_price_history", ("products",), CPH_SQL, {"scrapes": SCRAPES_SQL})
def d08(t):
    """Weekly competitor price per product: last scrape, promo flag, price index."""
    return price_history(t)


@query("x_prod02_competitor_update_not_in_future", ("products",), f"""
SELECT competitor, product_id, batch_week FROM cph WHERE NOT coalesce(update_timestamp <= {NOW}, false)""", {"scrapes": SCRAPES_SQL, "cph": CPH_SQL})
def x_prod02(t):
    """Competitor price rows stamped in the future."""
    return price_history(t).where(X.violates(F.col("update_timestamp") <= X.ts(X.DEFAULT_NOW))).select("competitor", "product_id", "batch_week")


T03_STEPS = [
    Step("set", "scraped_price", 0.02, "zero or negative scraped price",
         value=lambda u: F.when(u < 0.5, F.lit(0).cast("decimal(18,2)")).otherwise(money(-(1 + u * 49))),
         sql_value=f"CASE WHEN {{u}} < 0.5 THEN CAST(0 AS DECIMAL(18,2)) ELSE {money_sql('-(1 + {u} * 49)')} END"),
    Step("set", "scraped_price", 0.02, "price spike greater than 5x", value=lambda u: money(F.col("scraped_price") * (5.5 + u * 4.5)),
         sql_value=money_sql("scraped_price * (5.5 + {u} * 4.5)")),
    Step("set", "update_timestamp", 0.02, "future update timestamp", value=lambda u: future_date(u).cast("timestamp_ntz"),
         sql_value=FUTURE_TS_SQL),
    Step("dup", None, 0.04, "duplicate row"),
    Step("null", "category", 0.03, "missing category"),
    Step("set", "has_active_promo", 0.05, "promo flag stored as text", value=lambda u: F.when(F.col("has_active_promo") == "true", "Y").otherwise("N"),
         sql_value="CASE WHEN has_active_promo = 'true' THEN 'Y' ELSE 'N' END"),
]
CPH_RK = "concat_ws('-', product_id, competitor, datediff('day', DATE '1990-01-01', batch_week))"


@query("t03_competitor_price_history_faults", ("products",), None)
def t03(t):
    """Competitor price history after its seeded fault plan."""
    d = price_history(t).join(t.view("products").select("product_id", "category"), "product_id", "left").withColumn(
        "has_active_promo", F.col("has_active_promo").cast("string"))
    d = d.withColumn("__rk", F.concat_ws("-", "product_id", "competitor", F.datediff("batch_week", F.lit("1990-01-01").cast("date"))))
    return E.apply_plan(d, T03_STEPS, "__rk", "arith").select(*T03_COLUMNS)


T03_COLUMNS = ["competitor", "product_id", "batch_week", "scraped_price", "update_timestamp", "category", "has_active_promo", ERR]
CPH_B_SQL = f"""SELECT cph.* REPLACE (CAST(has_active_promo AS VARCHAR) AS has_active_promo), p.category, {CPH_RK.replace('product_id', 'cph.product_id')} AS __rk
FROM cph LEFT JOIN products p ON p.product_id = cph.product_id"""


def _t03_ctes():
    ctes, last = E.plan_sql("cph_b", T03_STEPS, "__rk", [])
    return {"scrapes": SCRAPES_SQL, "cph": CPH_SQL, "cph_b": CPH_B_SQL, **ctes}, last


def _t03_sql():
    ctes, last = _t03_ctes()
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + f"\nSELECT {', '.join(T03_COLUMNS)} FROM {last}"


from aislekit.plans.registry import QUERIES as _Q, Query as _Qy  # noqa: E402
from aislekit.sources.adapters import with_views as _wv  # noqa: E402

_Q["t03_competitor_price_history_faults"] = _Qy("t03_competitor_price_history_faults", t03, _wv(("products",), _t03_sql()))

T06_STEPS = [
    Step("set", "stock_status", 0.03, "invalid stock status value",
         value=lambda u: F.element_at(F.array(*[F.lit(x) for x in ["STOCKED", "unavailable", "tbc", "999", "no stock", "0"]]),
                                      (F.floor(u * 6) + 1).cast("int")),
         sql_value="['STOCKED', 'unavailable', 'tbc', '999', 'no stock', '0'][CAST(floor({u} * 6) + 1 AS INTEGER)]"),
    Step("set", "week_start_date", 0.02, "future week start date", value=future_date,
         sql_value="CAST(DATE '2025-01-01' + CAST(1 + floor({u} * 3650) AS INTEGER) AS DATE)"),
    Step("null", "stock_status", 0.02, "missing snapshot data"),
    Step("set", "stock_band", 1.0, "missing snapshot data", value=lambda u: F.lit(None).cast("string"),
         mask=lambda: F.array_contains("error_types", "missing snapshot data"), sql_value="CAST(NULL AS VARCHAR)",
         sql_mask="list_contains(error_types, 'missing snapshot data')"),
    Step("dup", None, 0.01, "duplicate row"),
]
SNAP_RK = "(store_id * 1000 + product_id) * 100000 + datediff('day', TIMESTAMP '1990-01-01', event_timestamp)"


def t06(t):
    """Stock snapshots after their seeded fault plan."""
    d = snapshots_x(t).withColumn("__rk", (F.col("store_id") * 1000 + F.col("product_id")) * 100000
                                  + F.datediff(F.col("event_timestamp"), F.lit("1990-01-01").cast("timestamp")))
    return E.apply_plan(d, T06_STEPS, "__rk", "arith").select("store_id", "product_id", "event_timestamp", "week_start_date",
                                                              "stock_status", "stock_band", ERR)


def _t06_ctes():
    ctes, last = E.plan_sql("snap_b", T06_STEPS, "__rk", [])
    return {"ledger": LEDGER, "snaps": SNAPSHOTS, "snaps_w": SNAPS_W_SQL, "snap_b": f"SELECT *, {SNAP_RK} AS __rk FROM snaps_w", **ctes}, last


def _t06_sql():
    allc, last = _t06_ctes()
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in allc.items()) + \
        f"\nSELECT store_id, product_id, event_timestamp, week_start_date, stock_status, stock_band, error_types FROM {last}"


_Q["t06_stock_snapshots_faults"] = _Qy("t06_stock_snapshots_faults", t06, _wv(("inventory_change_events",), _t06_sql()))


@query("d12_monthly_signup_index", ("customers",), """
SELECT month, signups, round(signups / n, 6) AS observed_share, round(w / 13.3, 6) AS expected_share, round((signups / n) / (w / 13.3), 4) AS signup_index
FROM (SELECT month(signup_date) AS month, count(*) AS signups FROM customers WHERE signup_date IS NOT NULL GROUP BY 1) g,
     (SELECT count(*) AS n FROM customers WHERE signup_date IS NOT NULL) c,
     (SELECT * FROM (VALUES (1, 0.5), (2, 0.6), (3, 0.7), (4, 0.8), (5, 0.9), (6, 1.0), (7, 1.1), (8, 1.2), (9, 1.3), (10, 1.4), (11, 1.8), (12, 2.0)) v(m, w)) ww
WHERE ww.m = g.month""")
def d12(t):
    """Observed signup share per month against the seasonal month weights."""
    return D.monthly_signup_index(t.view("customers"))


@query("f36_category_standardise", ("store_catalogues", "products"), """
WITH m AS (SELECT s.store_category, p.category AS master_category, count(*) AS listings FROM store_catalogues s JOIN products p USING (product_id) GROUP BY 1, 2)
SELECT store_category, master_category, listings, count(*) OVER (PARTITION BY store_category) > 1 AS ambiguous FROM m""")
def f36(t):
    """Store category labels mapped to master categories; labels with several masters flagged."""
    j = t.view("store_catalogues").join(t.view("products").select("product_id", F.col("category").alias("master_category")), "product_id")
    m = j.groupBy("store_category", "master_category").agg(F.count(F.lit(1)).alias("listings"))
    n = m.groupBy("store_category").agg(F.count(F.lit(1)).alias("__n"))
    return m.join(n, "store_category").select("store_category", "master_category", "listings", (F.col("__n") > 1).alias("ambiguous"))


def _pattern_sql() -> str:
    parts = []
    for i, p in enumerate(fx.NAME_PATTERNS):
        e = "'" + p.replace("{brand}", "' || brand || '").replace("{product}", "' || product_name || '") + "'"
        parts.append(f"WHEN product_id % 9 = {i} THEN {e}")
    return "CASE " + " ".join(parts) + " END"


def _norm_sql(col: str) -> str:
    t = f"replace(lower({col}), lower(brand), '')"
    t = f"regexp_replace(regexp_replace({t}, '\\(.*?\\)', ' ', 'g'), '[^\\w\\s]', ' ', 'g')"
    return f"array_to_string(list_sort(list_distinct(list_filter(string_split_regex(trim({t}), '\\s+'), lambda w: w <> ''))), ' ')"


@query("f39_scraped_name_normalise", ("products",), f"""
SELECT product_id, {_norm_sql('nm')} AS normalised, {_norm_sql('nm')} = {_norm_sql('product_name')} AS matches_master
FROM (SELECT *, {_pattern_sql()} AS nm FROM products)""")
def f39(t):
    """Listing names in nine brand/product layouts normalised; equal to the master name's form?"""
    p = t.view("products")
    nm = fx.render_name_pattern(F.col("product_id") % 9, F.col("brand"), F.col("product_name"))
    a = fx.scraped_name_normalise(nm, F.col("brand"))
    b = fx.scraped_name_normalise(F.col("product_name"), F.col("brand"))
    return p.select("product_id", a.alias("normalised"), (a == b).alias("matches_master"))


def _fold_sql() -> str:
    folds = fx.default_folds()
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in folds.items())
    core = "regexp_extract(w, '^(.*?)([.,!?;:]*)$', 1)"
    tail = "regexp_extract(w, '^(.*?)([.,!?;:]*)$', 2)"
    rep = f"CASE lower({core}) {cases} END"
    return f"array_to_string(list_transform(string_split(review_text, ' '), lambda w: CASE WHEN {rep} IS NOT NULL THEN {rep} || {tail} ELSE w END), ' ')"


@query("f42_typo_fold", ("product_reviews",), f"SELECT review_id, {_fold_sql()} AS folded FROM product_reviews WHERE review_text IS NOT NULL")
def f42(t):
    """Review text with shorthand and typo tokens folded to standard words."""
    r = t.view("product_reviews").where(F.col("review_text").isNotNull())
    return r.select("review_id", fx.typo_fold(F.col("review_text")).alias("folded"))


# Bundle types allowed per campaign type.
BUNDLE_CAMPAIGN_COMPATIBILITY = {
    "Seasonal": ["Set", "2 For X"],
    "Clearance": ["Buy One, Get One", "Buy N Save X"],
    "Retention": ["Set", "Buy N Save X", "2 For X"],
    "Acquisition": ["Buy One, Get One", "2 For X", "Set"],
}


@query("j19_bundles_for_campaigns", ("bundle_items", "lifecycle_changes", "campaigns"), f"""
WITH w AS ({WIN_SQL}),
b AS (SELECT w.*, {BT_SQL} AS bundle_type FROM w WHERE window_start IS NOT NULL),
al AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, vs in BUNDLE_CAMPAIGN_COMPATIBILITY.items() for v in vs)}) v(campaign_type, bundle_type))
SELECT c.campaign_id, b.bundle_id FROM campaigns c JOIN al USING (campaign_type) JOIN b USING (bundle_type)
WHERE b.window_start <= c.start_date AND b.window_end >= c.end_date""")
def j19(t):
    """Bundles of an allowed type whose window contains the campaign's window."""
    b = _windows(t).where(F.col("window_start").isNotNull()).withColumn("bundle_type", bundle_type_col())
    allowed = t.spark.createDataFrame([(k, v) for k, vs in BUNDLE_CAMPAIGN_COMPATIBILITY.items() for v in vs],
                                      "campaign_type string, bundle_type string")
    c = t.view("campaigns").join(F.broadcast(allowed), "campaign_type")  # fixed 10-row table
    j = J.windows_around(b, "window_start", "window_end", c, "start_date", "end_date", ["bundle_type"])
    return j.select("campaign_id", "bundle_id").distinct()


@query("v13_nested_foreign_keys", BASKET_VIEWS, PRICED + """
SELECT transaction_id, p.promotion_id FROM (SELECT transaction_id, unnest(applied_promotions) AS p FROM hdr)
WHERE p.promotion_id IS NOT NULL AND p.promotion_id NOT IN (SELECT CAST(promotion_id AS VARCHAR) FROM promotions)""")
def v13(t):
    """Applied promotion ids that are not known promotions."""
    return V.nested_orphans(priced(t)["transactions"], "transaction_id", "applied_promotions", "promotion_id",
                            t.view("promotions"), "promotion_id")


@query("v14_nested_bridge_unique", BASKET_VIEWS, PRICED + """
SELECT transaction_id, p.promotion_id AS promotion_id, count(*) AS n FROM (SELECT transaction_id, unnest(applied_promotions) AS p FROM hdr)
WHERE p.promotion_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def v14(t):
    """(transaction, applied promotion) pairs listed more than once."""
    return V.nested_bridge_duplicates(priced(t)["transactions"], "transaction_id", "applied_promotions", "promotion_id")


def _missing_field_sql() -> str:
    prof = f"CASE WHEN su < 0.65 THEN 'clean' WHEN su < 0.85 THEN 'light_noise' WHEN su < 0.95 THEN 'moderate_noise' ELSE 'heavy_corruption' END"
    names = "[" + ", ".join(f"'{f}'" for f in E.MISSING_FIELDS) + "]"
    return f"""SELECT event_id, CASE WHEN p <> 'clean' AND b > 0 THEN ['missing ' || {names}[CAST(floor(fu * 11) + 1 AS INTEGER)]]
  ELSE CAST([] AS VARCHAR[]) END AS error_types FROM (
 SELECT event_id, p, fu, CASE WHEN p = 'clean' THEN 0 ELSE CASE WHEN bu < exp(-CASE p WHEN 'light_noise' THEN 1 WHEN 'moderate_noise' THEN 2 ELSE 4 END) THEN 0 ELSE 1 END END AS b FROM (
  SELECT event_id, {prof} AS p, {arith_u_sql('event_id', 12)} AS bu, {arith_u_sql('event_id', 13)} AS fu FROM (
   SELECT event_id, {arith_u_sql("customer_id * 10000 + datediff('day', DATE '2024-01-01', CAST(event_timestamp AS DATE))", 11)} AS su FROM enr)))"""


@query("e07_missing_field", ("clickstreams", "products"), _missing_field_sql(), ENR)
def e07(t):
    """Events with a corruption budget lose one field, picked by hash (label 'missing <field>')."""
    e = enriched(t)
    key = F.col("customer_id") * 10000 + F.datediff(F.to_date("event_timestamp"), F.lit("2024-01-01").cast("date"))
    prof = E.session_profile(key, 11, "arith")
    budget = E.corruption_budget(prof, F.col("event_id"), 12, "arith")
    names = F.array(*[F.lit(f) for f in E.MISSING_FIELDS])
    field = F.element_at(names, (F.floor(E.draw(F.col("event_id"), 13, "arith") * 11) + 1).cast("int"))
    lab = F.when(budget > 0, F.array(F.concat(F.lit("missing "), field))).otherwise(F.array().cast("array<string>"))
    return e.select("event_id", lab.alias(ERR))


@query("e15_duplicate_event", ("clickstreams",), f"""
WITH x AS (SELECT event_id, event_timestamp, CASE WHEN su < 0.65 THEN 0.01 WHEN su < 0.85 THEN 0.03 WHEN su < 0.95 THEN 0.08 ELSE 0.15 END AS rate,
   {arith_u_sql('event_id', 31)} AS u, {arith_u_sql('event_id', 32)} AS u2 FROM (
   SELECT *, {arith_u_sql("customer_id * 10000 + datediff('day', DATE '2024-01-01', CAST(event_timestamp AS DATE))", 11)} AS su FROM clickstreams))
SELECT event_id, event_timestamp, CAST([] AS VARCHAR[]) AS error_types FROM x
UNION ALL SELECT event_id, event_timestamp + to_seconds(CAST(1 + floor(u2 * 3) AS BIGINT)), ['duplicate event'] FROM x WHERE u < rate""")
def e15(t):
    """Events copied 1-3 s later at the session profile's duplicate rate."""
    c = t.view("clickstreams")
    key = F.col("customer_id") * 10000 + F.datediff(F.to_date("event_timestamp"), F.lit("2024-01-01").cast("date"))
    prof = E.session_profile(key, 11, "arith")
    rate = F.element_at(F.create_map(*[x for k, v in E.DUP_PROB.items() for x in (F.lit(k), F.lit(v))]), prof)
    base = c.select("event_id", "event_timestamp", F.array().cast("array<string>").alias(ERR))
    dup = c.where(E.draw(F.col("event_id"), 31, "arith") < rate).select(
        "event_id", (F.col("event_timestamp") + F.make_interval(secs=(1 + F.floor(E.draw(F.col("event_id"), 32, "arith") * 3)).cast("int"))).alias("event_timestamp"),
        F.array(F.lit("duplicate event")).alias(ERR))
    return base.unionByName(dup)


from aislekit.plans.bundles_u import BUNDLES_SQL  # noqa: E402

T09_STEPS = [
    Step("ws", "bundle_name", 0.02, "bundle name formatting anomaly"),
    Step("set", "bundle_id", 0.02, "duplicate bundle id", value=lambda u: F.col("bundle_id") + 40, sql_value="bundle_id + 40"),
]
BUNDLE_TABLE_SQL = f"""SELECT bundle_id, bundle_type, categories, bundle_type || ' ' || array_to_string(categories, ' & ') AS bundle_name, bundle_id AS __rk
FROM ({BUNDLES_SQL})"""


def bundles_table(t):
    bi = t.view("bundle_items").join(t.view("products").select("product_id", "category"), "product_id")
    b = bi.groupBy("bundle_id").agg(F.sort_array(F.collect_set("category")).alias("categories")).withColumn("bundle_type", bundle_type_col())
    return b.select("bundle_id", "bundle_type", "categories",
                    F.concat_ws(" ", F.col("bundle_type"), F.array_join("categories", " & ")).alias("bundle_name"),
                    F.col("bundle_id").alias("__rk"))


def t09(t):
    """Bundles after their seeded fault plan (name noise, repeated ids)."""
    return E.apply_plan(bundles_table(t), T09_STEPS, "__rk", "arith").select("__rk", "bundle_id", "bundle_name", ERR)


def _t09_sql():
    ctes, last = E.plan_sql("bundles_b", T09_STEPS, "__rk", [])
    allc = {"bundles_b": BUNDLE_TABLE_SQL, **ctes}
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in allc.items()) + f"\nSELECT __rk, bundle_id, bundle_name, error_types FROM {last}"


_Q["t09_bundles_faults"] = _Qy("t09_bundles_faults", t09, _wv(("bundle_items", "products"), _t09_sql()))
