"""Basket pricing on the folded basket lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import basket as B
from aislekit.plans.registry import query
from aislekit.plans.sql_basket import VIEWS, chain_sql

_CACHE_KEY = "__priced"


def priced(t):
    """Whole pricing chain over basket lines (lazy; built once per Tables)."""
    if _CACHE_KEY not in t._frames:
        t._frames[_CACHE_KEY] = B.price_baskets(
            t.view("basket_items"), t.view("transactions"), t.view("promotions"), t.view("bundle_items"),
            t.view("bundle_pricings"), t.view("customers"), t.view("stores"))
    return t._frames[_CACHE_KEY]


@query("b01_cart_lines", ("products",), """
SELECT l_orderkey AS transaction_id, l_partkey + 100 AS product_id, count(*) AS quantity, coalesce(p.product_name, 'Unknown Product') AS product_name,
  p.category, CAST(p.selling_price AS DECIMAL(18,2)) AS unit_price
FROM lineitem JOIN products p ON p.product_id = l_partkey + 100 GROUP BY l_orderkey, l_partkey + 100, p.product_name, p.category, p.selling_price""")
def b01(t):
    """Item ids (part key + 100, so some are unknown) -> priced cart lines."""
    items = t.lineitem.select(F.col("l_orderkey").alias("transaction_id"), (F.col("l_partkey") + 100).alias("product_id"))
    return B.cart_lines(items, t.view("products"))


@query("b02_cart_subtotal", ("basket_items",), """
SELECT transaction_id, CAST(round(sum(unit_price * quantity), 2) AS DECIMAL(18,2)) AS cart_subtotal FROM basket_items GROUP BY 1""")
def b02(t):
    """Cart subtotal of every basket."""
    return B.cart_subtotals(t.view("basket_items"))


@query("b03_bundle_valid", ("basket_items", "bundle_items"), """
SELECT l.transaction_id, bi.bundle_id FROM bundle_items bi JOIN basket_items l ON l.product_id = bi.product_id
GROUP BY 1, 2 HAVING count(*) FILTER (WHERE l.quantity >= bi.quantity) = max((SELECT count(*) FROM bundle_items b2 WHERE b2.bundle_id = bi.bundle_id))""")
def b03(t):
    """Baskets holding every member of a bundle in at least its quantity."""
    return B.valid_bundles(t.view("basket_items"), t.view("bundle_items"))


@query("b04_eligible_promotions", VIEWS, chain_sql("SELECT transaction_id, promotion_id, promotion_scope, priority FROM elig"))
def b04(t):
    """Promotions eligible for each basket (time, min spend, scope)."""
    return priced(t)["eligible"].select("transaction_id", "promotion_id", "promotion_scope", "priority")


@query("b05_overlap", VIEWS, chain_sql("""
SELECT c.transaction_id, c.promotion_id, count(*) FILTER (WHERE k.n > 1) AS contested_products, count(*) FILTER (WHERE k.n > 1) > 0 AS overlaps
FROM (SELECT transaction_id, promotion_id, unnest(CASE WHEN len(cover) = 0 THEN [NULL] ELSE cover END) AS pid FROM cov) c
LEFT JOIN (SELECT transaction_id, pid, count(DISTINCT promotion_id) AS n FROM (SELECT transaction_id, promotion_id, unnest(cover) AS pid FROM cov) GROUP BY 1, 2) k
  USING (transaction_id, pid) GROUP BY 1, 2"""))
def b05(t):
    """Per eligible promotion: products it claims that another one also claims."""
    return B.promotion_conflicts(priced(t)["covers"])


@query("b06_viable", VIEWS, chain_sql("SELECT transaction_id, promotion_id, viable FROM disc"))
def b06(t):
    """Whether each eligible promotion's discount is viable."""
    return priced(t)["discounts"].select("transaction_id", "promotion_id", "viable")


@query("b07_discount", VIEWS, chain_sql("SELECT transaction_id, promotion_id, discount FROM disc"))
def b07_alone(t):
    """Discount of every eligible promotion."""
    return priced(t)["discounts"].select("transaction_id", "promotion_id", "discount")


@query("b06_b07_discounts", VIEWS, chain_sql("SELECT transaction_id, promotion_id, viable, discount FROM disc"))
def b07(t):
    """Viability and discount of every eligible promotion."""
    return priced(t)["discounts"].select("transaction_id", "promotion_id", "viable", "discount")


@query("b08_allocation", VIEWS, chain_sql("SELECT transaction_id, promotion_id, product_id, allocated FROM alloc"))
def b08(t):
    """Cent-exact allocation of each discount over the lines it covers."""
    return priced(t)["allocation"]


@query("b09_resolve_stack", VIEWS, chain_sql("SELECT transaction_id, promotion_id FROM selected"))
def b09(t):
    """Promotions kept by the in-store stacking rule."""
    return priced(t)["selected"]


@query("b10_stacking_priority", ("promotions",), """
SELECT promotion_id, CASE promotion_scope WHEN 'bundle' THEN 4 WHEN 'product' THEN 3 WHEN 'category' THEN 2 WHEN 'cart' THEN 1 END AS stacking_priority
FROM promotions""")
def b10(t):
    """Stacking priority of every promotion from its scope."""
    return t.view("promotions").select("promotion_id", B.stacking_priority(F.col("promotion_scope")).alias("stacking_priority"))


@query("b11_shipping_promo", VIEWS, chain_sql("SELECT transaction_id, shipping_promotion_id FROM ship"))
def b11(t):
    """Best free-shipping promotion of each basket (lowest min spend)."""
    return B.shipping_promo(priced(t)["eligible"])


@query("b12_shipping_fee", ("transactions", "customers", "stores"), """
SELECT h.transaction_id, CAST(round((CASE WHEN h.store_id = 0 THEN 8 ELSE 4 END) + (CASE WHEN c.region IS DISTINCT FROM st.region THEN 8
  WHEN c.area IS DISTINCT FROM st.area THEN 4 ELSE 0 END) + 1.0, 2) AS DECIMAL(18,2)) AS shipping_fee
FROM transactions h LEFT JOIN customers c USING (customer_id) LEFT JOIN stores st ON st.store_id = h.store_id""")
def b12(t):
    """Shipping fee of every transaction from store type and distance."""
    c = t.view("customers").select("customer_id", F.col("region").alias("cr"), F.col("area").alias("ca"))
    s = t.view("stores").select("store_id", F.col("region").alias("sr"), F.col("area").alias("sa"))
    j = t.view("transactions").join(c, "customer_id", "left").join(s, "store_id", "left")
    return j.select("transaction_id", B.shipping_fee(F.col("store_id") == 0, F.col("cr"), F.col("sr"), F.col("ca"), F.col("sa")).alias("shipping_fee"))


@query("b13_item_lines", VIEWS, chain_sql("SELECT transaction_id, product_id, quantity, unit_price, item_subtotal, item_discount, final_item_price FROM items"))
def b13(t):
    """Priced basket lines: subtotal, capped discount, final price."""
    return priced(t)["items"].select("transaction_id", "product_id", "quantity", "unit_price", "item_subtotal",
                                     "item_discount", "final_item_price")


@query("b14_header_totals", VIEWS, chain_sql("""SELECT transaction_id, cart_subtotal, total_discount, shipping_fee, shipping_discount,
  transaction_total, basket_size, num_unique_items FROM hdr"""))
def b14(t):
    """Priced transaction headers (subtotal, discounts, fees, total, sizes)."""
    return priced(t)["transactions"].select("transaction_id", "cart_subtotal", "total_discount", "shipping_fee",
                                            "shipping_discount", "transaction_total", "basket_size", "num_unique_items")


@query("b15_reconcile", VIEWS, chain_sql("""
SELECT h.transaction_id, h.transaction_total, i.items_total, CAST(round(i.items_total + h.shipping_fee - h.shipping_discount, 2) AS DECIMAL(18,2)) AS expected_total
FROM hdr h JOIN (SELECT transaction_id, CAST(round(sum(final_item_price), 2) AS DECIMAL(18,2)) AS items_total FROM items GROUP BY 1) i USING (transaction_id)
WHERE abs(h.transaction_total - (i.items_total + h.shipping_fee - h.shipping_discount)) > 0.05"""))
def b15(t):
    """Headers whose total does not reconcile with their lines (> 0.05)."""
    p = priced(t)
    return B.reconcile(p["transactions"], p["items"])


@query("b16_applied_promotions", VIEWS, chain_sql("SELECT transaction_id, applied_promotions FROM hdr"))
def b16(t):
    """Applied promotions (id, mechanic, amount) of every priced basket."""
    return priced(t)["transactions"].select("transaction_id", "applied_promotions")


@query("b20_bundle_purchase", ("basket_items", "bundle_items"), """
WITH j AS (SELECT bi.bundle_id, bi.product_id, bi.quantity AS req, l.transaction_id, l.quantity FROM bundle_items bi JOIN basket_items l USING (product_id)),
vb AS (SELECT transaction_id, bundle_id FROM j GROUP BY 1, 2 HAVING count(*) FILTER (WHERE quantity >= req) = max((SELECT count(*) FROM bundle_items b2 WHERE b2.bundle_id = j.bundle_id))),
sets AS (SELECT j.transaction_id, j.bundle_id, CAST(min(floor(j.quantity / j.req)) AS BIGINT) AS complete_sets FROM j JOIN vb USING (transaction_id, bundle_id) GROUP BY 1, 2)
SELECT j.transaction_id, j.bundle_id, j.product_id, s.complete_sets, CAST(j.quantity - s.complete_sets * j.req AS BIGINT) AS remaining_units
FROM j JOIN sets s USING (transaction_id, bundle_id)""")
def b20(t):
    """Complete bundle sets per basket and the units left per member."""
    return B.bundle_completions(t.view("basket_items"), t.view("bundle_items"))


@query("b22_basket_mission", VIEWS, chain_sql("""
SELECT transaction_id, CASE WHEN basket_size BETWEEN 1 AND 2 THEN 'Browsing' WHEN basket_size BETWEEN 1 AND 5 THEN 'Quick Top Up'
  WHEN basket_size BETWEEN 6 AND 15 THEN 'Regular Buy' WHEN basket_size BETWEEN 16 AND 40 THEN 'Bulk Buy' END AS mission FROM hdr"""))
def b22(t):
    """Shopping mission from the basket size band."""
    return priced(t)["transactions"].select("transaction_id", B.basket_mission(F.col("basket_size")).alias("mission"))
