"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import basket as B
from aislekit.operators import lookups as J
from aislekit.plans.derived import lifecycles, snapshots
from aislekit.plans.registry import query
from aislekit.plans.sql_common import LEDGER, LIFECYCLES, SNAPSHOTS

PL = {"pl": LIFECYCLES}
SNAP = {"ledger": LEDGER, "snaps": SNAPSHOTS}


@query("j01_products_versions", ("products", "lifecycle_changes"), "SELECT p.product_id, p.product_name, pl.status, pl.valid_from FROM products p JOIN pl USING (product_id)", PL)
def j01(t):
    """Products joined to every lifecycle version."""
    return J.with_versions(t.view("products"), lifecycles(t)).select("product_id", "product_name", "status", "valid_from")


@query("j02_pricing_bundles", ("bundle_pricings", "bundle_items"), """
SELECT bp.bundle_pricing_id, bp.bundle_id, b.members FROM bundle_pricings bp
LEFT JOIN (SELECT bundle_id, count(*) AS members FROM bundle_items GROUP BY 1) b USING (bundle_id)""")
def j02(t):
    """Bundle pricing rows left-joined to their bundle (member count)."""
    b = t.view("bundle_items").groupBy("bundle_id").agg(F.count(F.lit(1)).alias("members"))
    return t.view("bundle_pricings").join(b, "bundle_id", "left").select("bundle_pricing_id", "bundle_id", "members")


@query("j03_valid_transactions", ("transactions", "transaction_items"), """
SELECT t.transaction_id, t.customer_id, t.store_id, t.transaction_time, i.product_id, i.quantity FROM transactions t JOIN transaction_items i USING (transaction_id)""")
def j03(t):
    """Transaction headers (4 columns) joined to their items."""
    return J.valid_transactions(t.view("transactions"), t.view("transaction_items")).select(
        "transaction_id", "customer_id", "store_id", "transaction_time", "product_id", "quantity")


@query("j04_area_regions", ("customers",), "SELECT DISTINCT area, region FROM customers")
def j04(t):
    """Area -> region map."""
    return J.area_regions(t.view("customers"))


@query("j05_store_split", ("stores",), "SELECT store_id, store_type = 'Online' AS is_online FROM stores")
def j05(t):
    """Stores flagged online / retail (exactly one online store required)."""
    return J.split_stores(t.view("stores")).select("store_id", "is_online")


@query("j06_store_listing", ("store_catalogues", "products"), """
SELECT s.store_id, s.product_id, coalesce(nullif(s.store_product_name, ''), p.product_name) AS name,
  coalesce(nullif(s.store_category, ''), p.category) AS category,
  CAST(coalesce(nullif(s.store_selling_price, 0), p.selling_price) AS DECIMAL(18,2)) AS price
FROM store_catalogues s LEFT JOIN products p USING (product_id)
WHERE coalesce(nullif(s.store_selling_price, 0), p.selling_price) IS NOT NULL""")
def j06(t):
    """Store listing with master-data fallback for missing store values."""
    return J.store_listing(t.view("store_catalogues"), t.view("products"))


@query("j07_bundle_contents", ("bundle_items",), """
SELECT bundle_id, list({'key': product_id, 'value': quantity} ORDER BY product_id) AS contents FROM bundle_items GROUP BY 1""")
def j07(t):
    """Bundle -> {product: quantity} entries."""
    return J.bundle_contents(t.view("bundle_items")).select("bundle_id", F.map_entries("contents").alias("contents"))


@query("j08_category_members", ("products",), "SELECT DISTINCT category, product_id FROM products WHERE product_id IS NOT NULL")
def j08(t):
    """Category -> product rows."""
    return J.category_members(t.view("products"))


@query("j09_unique_guard", ("products",), "SELECT product_id FROM products")
def j09(t):
    """Products after the unique-key guard (fails on a repeated id)."""
    return J.assert_unique(t.view("products"), "product_id").select("product_id")


ESSENTIAL = ["ECONOMY", "STANDARD"]


@query("j10_essential_split", ("products",), """
SELECT product_id, category IN ('ECONOMY', 'STANDARD') AS essential FROM products WHERE category IS NOT NULL""")
def j10(t):
    """Products split into essential / non-essential by a category list."""
    ess, non = J.split_by_list(t.view("products"), "category", ESSENTIAL)
    return ess.select("product_id", F.lit(True).alias("essential")).unionByName(
        non.select("product_id", F.lit(False).alias("essential")))


@query("j11_search_reference", ("products",), """
SELECT category AS term FROM products UNION ALL SELECT brand FROM products UNION ALL SELECT product_name FROM products""")
def j11(t):
    """Search reference: categories, brands and item names (repeats kept)."""
    return J.search_reference(t.view("products"))


def _probes(t):
    return (t.view("basket_items").select("transaction_id", "product_id")
            .join(t.view("transactions").select("transaction_id", "store_id", "transaction_time"), "transaction_id"))


@query("j12_stock_asof", ("basket_items", "transactions", "inventory_change_events"), """
SELECT p.transaction_id, p.product_id, p.store_id, p.transaction_time, coalesce(s.stock_status, 'Out of Stock') AS stock_status
FROM (SELECT b.transaction_id, b.product_id, t.store_id, t.transaction_time FROM basket_items b JOIN transactions t USING (transaction_id)) p
ASOF LEFT JOIN snaps s ON p.store_id = s.store_id AND p.product_id = s.product_id AND p.transaction_time >= s.event_timestamp""", SNAP)
def j12(t):
    """As-of stock status of every basket line at its transaction time."""
    return J.stock_status_asof(_probes(t), snapshots(t))


@query("j13_bundle_price_at", ("basket_items", "bundle_items", "transactions", "bundle_pricings"), """
WITH vb AS (SELECT l.transaction_id, bi.bundle_id FROM bundle_items bi JOIN basket_items l ON l.product_id = bi.product_id
  GROUP BY 1, 2 HAVING count(*) FILTER (WHERE l.quantity >= bi.quantity) = max((SELECT count(*) FROM bundle_items b2 WHERE b2.bundle_id = bi.bundle_id))),
p AS (SELECT vb.*, t.transaction_time FROM vb JOIN transactions t USING (transaction_id))
SELECT p.transaction_id, p.bundle_id, (SELECT CAST(b.bundle_price AS DECIMAL(18,2)) FROM bundle_pricings b WHERE b.bundle_id = p.bundle_id
  AND b.effective_start_date <= p.transaction_time AND b.effective_end_date >= p.transaction_time
  ORDER BY b.effective_start_date DESC, b.bundle_pricing_id LIMIT 1) AS bundle_price FROM p""")
def j13(t):
    """Bundle price active at each basket's time (latest start wins)."""
    vb = B.valid_bundles(t.view("basket_items"), t.view("bundle_items"))
    pairs = vb.join(t.view("transactions").select("transaction_id", "transaction_time"), "transaction_id")
    return B.active_bundle_price(pairs, t.view("bundle_pricings")).select("transaction_id", "bundle_id", "bundle_price")


def _audience(t):
    c = t.view("customers").select("customer_id", "customer_segment", "signup_date")
    k = t.view("campaigns").select("campaign_id", "target_segment", "start_date", "end_date")
    return c.join(k, c.customer_segment == k.target_segment).where(F.col("signup_date") <= F.col("start_date"))


AUD_SQL = """SELECT c.customer_id, k.campaign_id, k.start_date, k.end_date FROM customers c JOIN campaigns k
  ON c.customer_segment = k.target_segment WHERE c.signup_date <= k.start_date"""


@query("j14_active_campaigns", ("customers", "campaigns", "transactions"), """
SELECT DISTINCT t.transaction_id, a.campaign_id FROM transactions t JOIN aud a ON a.customer_id = t.customer_id
  AND a.start_date <= t.transaction_time AND a.end_date >= t.transaction_time""", {"aud": AUD_SQL})
def j14(t):
    """Campaigns active for the buyer at each transaction time."""
    a = _audience(t).select("customer_id", "campaign_id", "start_date", "end_date")
    p = t.view("transactions").select("transaction_id", "customer_id", "transaction_time")
    return J.active_in_window(p, "transaction_time", a, "start_date", "end_date", keys=["customer_id"],
                              distinct_on=["transaction_id", "campaign_id"]).select("transaction_id", "campaign_id")


@query("j15_active_promotions", ("transactions", "promotions"), """
SELECT t.transaction_id, count(DISTINCT p.promotion_id) AS active_promotions FROM transactions t JOIN promotions p
  ON p.effective_start_date <= t.transaction_time AND p.effective_end_date >= t.transaction_time GROUP BY 1""")
def j15(t):
    """Number of promotions active at each transaction time."""
    p = t.view("transactions").select("transaction_id", "transaction_time")
    n = J.active_counts(p, "transaction_time", t.view("promotions"), "effective_start_date", "effective_end_date",
                        "active_promotions")
    return (p.join(n, F.col("transaction_time").cast("timestamp_ntz") == F.col("ts")).where("active_promotions > 0")
            .select("transaction_id", F.col("active_promotions").cast("long").alias("active_promotions")))


@query("j16_customer_promotions", ("promotions", "campaign_exposures"), """
WITH p AS (SELECT promotion_id, CASE WHEN promotion_scope = 'category' THEN promotion_id % 25 END AS campaign_id FROM promotions),
tr AS (SELECT DISTINCT campaign_id, customer_id FROM campaign_exposures WHERE assignment_group = 'Treatment')
SELECT tr.customer_id, p.promotion_id FROM p JOIN tr USING (campaign_id)
UNION ALL SELECT CAST(NULL AS BIGINT), promotion_id FROM p WHERE campaign_id IS NULL""")
def j16(t):
    """Promotions a customer may use: global ones, and campaign-linked ones
    only for that campaign's Treatment group."""
    p = t.view("promotions").select("promotion_id", F.when(F.col("promotion_scope") == "category",
                                                           F.col("promotion_id") % 25).alias("campaign_id"))
    tr = (t.view("campaign_exposures").where(F.col("assignment_group") == "Treatment")
          .select("campaign_id", "customer_id").distinct())
    return J.eligible_for_customer(p, tr)


def page_views(t):
    """Clickstream pages with the product's category, moved into the years of the promotions."""
    e = t.view("clickstreams").join(t.view("products").select("product_id", "category"), "product_id", "left")
    return e.withColumn("event_timestamp", F.col("event_timestamp") - F.make_interval(years=F.lit(28)))


@query("j17_page_promotions", ("clickstreams", "products", "promotions", "bundle_items"), """
WITH e AS (SELECT c.event_id, c.event_type, CAST(c.event_timestamp - INTERVAL '28' YEAR AS DATE) AS d, CAST(c.product_id AS VARCHAR) AS pid, p.category
  FROM clickstreams c LEFT JOIN products p USING (product_id))
SELECT DISTINCT event_id, promotion_id FROM (
 SELECT e.event_id, p.promotion_id FROM e JOIN promotions p ON p.promotion_scope = 'cart' AND d BETWEEN effective_start_date AND effective_end_date
   WHERE e.event_type IN ('Cart View', 'Checkout Start')
 UNION ALL SELECT e.event_id, p.promotion_id FROM e JOIN promotions p ON p.promotion_scope = 'category' AND p.promotion_target_id = e.category
   AND d BETWEEN effective_start_date AND effective_end_date WHERE e.event_type IN ('Category View', 'Product View')
 UNION ALL SELECT e.event_id, p.promotion_id FROM e JOIN promotions p ON p.promotion_scope = 'product' AND p.promotion_target_id = e.pid
   AND d BETWEEN effective_start_date AND effective_end_date WHERE e.event_type = 'Product View'
 UNION ALL SELECT e.event_id, p.promotion_id FROM e JOIN bundle_items bi ON CAST(bi.product_id AS VARCHAR) = e.pid
   JOIN promotions p ON p.promotion_scope = 'bundle' AND p.promotion_target_id = CAST(bi.bundle_id AS VARCHAR)
   AND d BETWEEN effective_start_date AND effective_end_date WHERE e.event_type = 'Product View')""")
def j17(t):
    """Promotions active and relevant on each clickstream page, by scope."""
    return J.page_promotions(page_views(t), t.view("promotions"), t.view("bundle_items"))


@query("j18_on_sale_through", ("lifecycle_changes", "campaigns"), """
WITH p AS (SELECT product_id, arg_max_null(launch_date, row(valid_from, is_current, status)) AS launch_date, arg_max_null(discontinuation_date, row(valid_from, is_current, status)) AS discontinuation_date FROM pl GROUP BY 1)
SELECT c.campaign_id, p.product_id FROM campaigns c JOIN p ON p.launch_date <= c.start_date
  AND (p.discontinuation_date IS NULL OR p.discontinuation_date >= c.end_date)""", PL)
def j18(t):
    """Products on sale through each whole campaign window."""
    p = J.launch_lookup(lifecycles(t))
    return J.on_sale_through(p, t.view("campaigns"), "start_date", "end_date", "campaign_id")


@query("j20_in_stock_products", ("basket_items", "transactions", "inventory_change_events", "products"), """
SELECT p.transaction_id, p.product_id, pr.category FROM (SELECT b.transaction_id, b.product_id, t.store_id, t.transaction_time
  FROM basket_items b JOIN transactions t USING (transaction_id)) p
ASOF LEFT JOIN snaps s ON p.store_id = s.store_id AND p.product_id = s.product_id AND p.transaction_time >= s.event_timestamp
JOIN products pr ON pr.product_id = p.product_id WHERE coalesce(s.stock_status, 'Out of Stock') <> 'Out of Stock'""", SNAP)
def j20(t):
    """Basket lines whose product was in stock at that store and time, with category."""
    pr = _probes(t).withColumnRenamed("transaction_time", "at")
    return J.in_stock_products(pr, snapshots(t), t.view("products")).select("transaction_id", "product_id", "category")


@query("j21_name_contains", ("products",), """
WITH terms AS (SELECT DISTINCT word AS term FROM (SELECT unnest(string_split(product_name, ' ')) AS word FROM products) WHERE word <> '')
SELECT DISTINCT terms.term, p.product_id FROM terms JOIN products p ON p.product_name IS NOT NULL AND contains(lower(p.product_name), lower(terms.term))""")
def j21(t):
    """Products whose name contains each search term (case-insensitive, literal)."""
    words = t.view("products").select(F.explode(F.split("product_name", " ")).alias("term")).where(F.col("term") != "")
    return J.name_contains(words, "term", t.view("products").select("product_id", "product_name"), "product_name") \
        .select("term", "product_id").distinct()


@query("j22_payment_successes", ("clickstreams",), "SELECT event_id, customer_id FROM clickstreams WHERE event_type = 'Payment Successful'")
def j22(t):
    """Successful payment events."""
    return J.payment_successes(t.view("clickstreams")).select("event_id", "customer_id")


@query("j23_stockouts_by_key", ("stockout_events",), """
SELECT store_id, product_id, list({'stockout_start_date': stockout_start_date, 'stockout_end_date': stockout_end_date}
  ORDER BY stockout_start_date, stockout_end_date) AS windows FROM stockout_events GROUP BY 1, 2""")
def j23(t):
    """Stockout windows grouped per (store, product), sorted."""
    return J.stockouts_by_key(t.view("stockout_events"))


LISTINGS_SQL = """SELECT store_id AS competitor, CASE WHEN product_id % 13 = 0 THEN NULL ELSE product_id END AS product_id,
  store_product_name AS product_name, store_brand AS brand FROM store_catalogues"""


@query("j25_competitor_catalogue", ("store_catalogues",), """
WITH a AS (SELECT competitor, product_id, product_name, brand FROM (SELECT *, row_number() OVER (PARTITION BY competitor, product_id
   ORDER BY product_name NULLS FIRST, brand NULLS FIRST) AS rn FROM listings WHERE product_id IS NOT NULL) WHERE rn = 1
 UNION ALL SELECT competitor, product_id, product_name, brand FROM listings WHERE product_id IS NULL)
SELECT competitor, product_name, product_id, brand, product_id IS NULL AS is_exclusive FROM (SELECT *, row_number() OVER (
  PARTITION BY competitor, product_name ORDER BY product_id NULLS FIRST, brand NULLS FIRST) AS rn FROM a) WHERE rn = 1""", {"listings": LISTINGS_SQL})
def j25(t):
    """Competitor catalogue without repeated products or names; exclusives flagged."""
    l = t.view("store_catalogues").select(F.col("store_id").alias("competitor"),
                                          F.when(F.col("product_id") % 13 != 0, F.col("product_id")).alias("product_id"),
                                          F.col("store_product_name").alias("product_name"), F.col("store_brand").alias("brand"))
    return J.competitor_catalogue(l).select("competitor", "product_name", "product_id", "brand", "is_exclusive")


@query("j26_pick_store", ("customers", "stores"), """
WITH r AS (SELECT * FROM stores WHERE store_type <> 'Online'),
ba AS (SELECT store_id, area, row_number() OVER (PARTITION BY area ORDER BY store_id) AS pos, count(*) OVER (PARTITION BY area) AS n FROM r),
al AS (SELECT store_id, row_number() OVER (ORDER BY store_id) AS pos FROM r),
c AS (SELECT customer_id, area, ((customer_id % 1000003) * 2654435761 + 7) % 1000003 AS h FROM customers)
SELECT c.customer_id, coalesce((SELECT ba.store_id FROM ba WHERE ba.area = c.area AND ba.pos = c.h % ba.n + 1),
  (SELECT al.store_id FROM al WHERE al.pos = c.h % (SELECT count(*) FROM r) + 1)) AS store_id FROM c""")
def j26(t):
    """One store per customer: in the home area, else any retail store, by hash rank."""
    key = (F.pmod(F.col("customer_id"), F.lit(1000003)) * 2654435761 + 7) % 1000003
    return J.pick_store(t.view("customers"), t.view("stores"), rank_key=key)


@query("j27_customer_lookup", ("customers",), """
SELECT customer_id, customer_type, customer_segment, area, region, count(*) OVER (PARTITION BY customer_type) AS customers_of_type FROM customers""")
def j27(t):
    """Type, segment, area and region by customer, with the size of its type."""
    c = t.view("customers")
    n = c.groupBy("customer_type").agg(F.count(F.lit(1)).alias("customers_of_type"))
    return c.select("customer_id", "customer_type", "customer_segment", "area", "region").join(n, "customer_type")


@query("j28_digital_customers", ("customers",), "SELECT customer_id FROM customers WHERE customer_type IN ('Online Only', 'Omnichannel')")
def j28(t):
    """Online Only and Omnichannel customers."""
    return J.digital_customers(t.view("customers")).select("customer_id")


@query("j29_review_candidates", ("transactions", "transaction_items", "products"), """
SELECT DISTINCT t.transaction_id, i.product_id, t.customer_id FROM transactions t JOIN transaction_items i USING (transaction_id)
WHERE i.product_id IN (SELECT product_id FROM products)""")
def j29(t):
    """Purchased (transaction, product) pairs of known products."""
    return J.review_candidates(t.view("transactions"), t.view("transaction_items"), t.view("products")) \
        .select("transaction_id", "product_id", "customer_id")


@query("j30_store_catalogue", ("store_catalogues",), "SELECT DISTINCT store_id, product_id FROM store_catalogues ORDER BY 1, 2")
def j30(t):
    """Store assortment: distinct (store, product), ordered."""
    return t.view("store_catalogues").select("store_id", "product_id").dropDuplicates().orderBy("store_id", "product_id")


@query("j31_launch_lookup", ("lifecycle_changes",), """
SELECT product_id, arg_max_null(launch_date, row(valid_from, is_current, status)) AS launch_date, arg_max_null(discontinuation_date, row(valid_from, is_current, status)) AS discontinuation_date FROM pl GROUP BY 1""", PL)
def j31(t):
    """Launch and discontinuation per product from its last version."""
    return J.launch_lookup(lifecycles(t))
