"""Oracle-side SQL (DuckDB) of the basket pricing chain, as CTE text."""

VIEWS = ("basket_items", "transactions", "promotions", "bundle_items", "bundle_pricings", "customers", "stores")

CHAIN = """
lines AS (SELECT transaction_id, product_id, category, quantity, unit_price FROM basket_items),
sub AS (SELECT transaction_id, CAST(round(sum(unit_price * quantity), 2) AS DECIMAL(18,2)) AS cart_subtotal FROM lines GROUP BY 1),
members AS (SELECT bundle_id, count(*) AS n FROM bundle_items GROUP BY 1),
vb AS (SELECT l.transaction_id, bi.bundle_id FROM bundle_items bi JOIN lines l ON l.product_id = bi.product_id
       GROUP BY 1, 2 HAVING count(*) FILTER (WHERE l.quantity >= bi.quantity) = max((SELECT n FROM members m WHERE m.bundle_id = bi.bundle_id))),
elig AS (
 SELECT h.transaction_id, p.promotion_id, p.promotion_scope, p.promotion_mechanic, p.promotion_target_id,
   CAST(p.promotion_value AS DECIMAL(18,2)) AS promotion_value, CAST(p.min_spend AS DECIMAL(18,2)) AS min_spend,
   CAST(p.priority AS INTEGER) AS priority, s.cart_subtotal
 FROM transactions h JOIN sub s USING (transaction_id) JOIN promotions p
   ON p.effective_start_date <= h.transaction_time AND p.effective_end_date >= h.transaction_time
 WHERE (p.min_spend IS NULL OR s.cart_subtotal >= p.min_spend) AND (
   p.promotion_scope = 'cart'
   OR (p.promotion_scope = 'product' AND EXISTS (SELECT 1 FROM lines l WHERE l.transaction_id = h.transaction_id AND CAST(l.product_id AS VARCHAR) = p.promotion_target_id))
   OR (p.promotion_scope = 'category' AND EXISTS (SELECT 1 FROM lines l WHERE l.transaction_id = h.transaction_id AND l.category = p.promotion_target_id))
   OR (p.promotion_scope = 'bundle' AND EXISTS (SELECT 1 FROM vb WHERE vb.transaction_id = h.transaction_id AND CAST(vb.bundle_id AS VARCHAR) = p.promotion_target_id)))),
plines AS (
 SELECT e.transaction_id, e.promotion_id, l.product_id, CAST(l.unit_price * l.quantity AS DECIMAL(38,6)) AS line_total
 FROM elig e JOIN lines l ON l.transaction_id = e.transaction_id
 WHERE (e.promotion_scope = 'product' AND CAST(l.product_id AS VARCHAR) = e.promotion_target_id)
    OR (e.promotion_scope = 'category' AND l.category = e.promotion_target_id)
    OR (e.promotion_scope = 'bundle' AND EXISTS (SELECT 1 FROM bundle_items bi WHERE CAST(bi.bundle_id AS VARCHAR) = e.promotion_target_id AND bi.product_id = l.product_id))),
pa AS (SELECT transaction_id, promotion_id, sum(line_total) AS elig_subtotal, max(product_id) AS last_pid,
       arg_min(line_total, product_id) AS first_total FROM plines GROUP BY 1, 2),
bp AS (
 SELECT transaction_id, bt, bundle_price FROM (
  SELECT e.transaction_id, e.promotion_target_id AS bt, CAST(b.bundle_price AS DECIMAL(18,2)) AS bundle_price,
    row_number() OVER (PARTITION BY e.transaction_id, e.promotion_target_id ORDER BY b.effective_start_date DESC, b.bundle_pricing_id) AS rn
  FROM elig e JOIN transactions h USING (transaction_id) JOIN bundle_pricings b ON CAST(b.bundle_id AS VARCHAR) = e.promotion_target_id
    AND b.effective_start_date <= h.transaction_time AND b.effective_end_date >= h.transaction_time
  WHERE e.promotion_scope = 'bundle') WHERE rn = 1),
dz AS (
 SELECT e.*, pa.elig_subtotal, pa.last_pid, bp.bundle_price,
  CASE WHEN pa.elig_subtotal IS NULL THEN false
       WHEN e.promotion_mechanic = 'percentage_discount' THEN e.promotion_value <= 40
       WHEN e.promotion_mechanic = 'dollar_discount' AND e.promotion_scope = 'product'
         THEN e.promotion_value < round(pa.first_total, 2) AND e.promotion_value <= round(pa.first_total, 2) * 0.40
       WHEN e.promotion_mechanic = 'dollar_discount' AND e.promotion_scope = 'category'
         THEN e.promotion_value < round(pa.elig_subtotal, 2) AND e.promotion_value <= round(pa.elig_subtotal, 2) * 0.40
       ELSE true END AS viable
 FROM elig e LEFT JOIN pa USING (transaction_id, promotion_id)
 LEFT JOIN bp ON bp.transaction_id = e.transaction_id AND bp.bt = e.promotion_target_id AND e.promotion_scope = 'bundle'),
disc AS (
 SELECT *, coalesce(CAST(round(CAST(CASE WHEN promotion_scope = 'cart' THEN 0 WHEN NOT viable THEN 0
     WHEN promotion_mechanic = 'percentage_discount' THEN elig_subtotal * promotion_value * 0.01
     WHEN promotion_mechanic = 'dollar_discount' THEN least(CAST(promotion_value AS DECIMAL(38,6)), elig_subtotal)
     WHEN promotion_mechanic = 'bundle' THEN CASE WHEN bundle_price IS NULL THEN 0 ELSE greatest(elig_subtotal - bundle_price, 0) END
     ELSE 0 END AS DECIMAL(38,6)), 2) AS DECIMAL(18,2)), 0) AS discount
 FROM dz),
alloc0 AS (
 SELECT plines.transaction_id, plines.promotion_id, plines.product_id, d.discount, d.last_pid,
   CASE WHEN plines.product_id = d.last_pid THEN NULL ELSE CAST(round(CAST(d.discount * plines.line_total / d.elig_subtotal AS DECIMAL(38,6)), 2) AS DECIMAL(18,2)) END AS share
 FROM plines JOIN disc d USING (transaction_id, promotion_id)),
alloc AS (
 SELECT transaction_id, promotion_id, product_id,
   CAST(CASE WHEN discount <= 0 THEN 0 WHEN product_id = last_pid
     THEN discount - coalesce(sum(share) OVER (PARTITION BY transaction_id, promotion_id), 0) ELSE share END AS DECIMAL(18,2)) AS allocated
 FROM alloc0),
cov AS (
 SELECT transaction_id, promotion_id, [promotion_target_id] AS cover FROM elig WHERE promotion_scope = 'product'
 UNION ALL
 SELECT e.transaction_id, e.promotion_id, list_distinct(list(CAST(l.product_id AS VARCHAR)))
 FROM elig e JOIN lines l ON l.transaction_id = e.transaction_id AND l.category = e.promotion_target_id
 WHERE e.promotion_scope = 'category' GROUP BY 1, 2
 UNION ALL
 SELECT e.transaction_id, e.promotion_id, coalesce((SELECT list(DISTINCT CAST(bi.product_id AS VARCHAR)) FROM bundle_items bi
   WHERE CAST(bi.bundle_id AS VARCHAR) = e.promotion_target_id), CAST([] AS VARCHAR[]))
 FROM elig e WHERE e.promotion_scope = 'bundle'
 UNION ALL
 SELECT transaction_id, promotion_id, CAST([] AS VARCHAR[]) FROM elig WHERE promotion_scope = 'cart'),
cand AS (
 SELECT d.transaction_id, d.promotion_id, d.discount, c.cover,
   row_number() OVER (PARTITION BY d.transaction_id ORDER BY d.priority DESC, d.promotion_id) AS k
 FROM disc d JOIN cov c USING (transaction_id, promotion_id) WHERE d.promotion_mechanic <> 'free_shipping'),
st AS (
 SELECT DISTINCT transaction_id, CAST(0 AS BIGINT) AS k,
   CAST([] AS STRUCT(promotion_id BIGINT, discount DECIMAL(18,2), cover VARCHAR[])[]) AS sel FROM cand
 UNION ALL
 SELECT s.transaction_id, s.k + 1,
   CASE WHEN len(list_filter(s.sel, lambda x: len(list_intersect(x.cover, c.cover)) > 0)) = 0
          THEN list_append(s.sel, {'promotion_id': c.promotion_id, 'discount': c.discount, 'cover': c.cover})
        WHEN c.discount > coalesce(list_sum(list_transform(list_filter(s.sel, lambda x: len(list_intersect(x.cover, c.cover)) > 0), lambda x: x.discount)), 0)
          THEN list_append(list_filter(s.sel, lambda x: len(list_intersect(x.cover, c.cover)) = 0),
                           {'promotion_id': c.promotion_id, 'discount': c.discount, 'cover': c.cover})
        ELSE s.sel END
 FROM st s JOIN cand c ON c.transaction_id = s.transaction_id AND c.k = s.k + 1),
selected AS (
 SELECT transaction_id, unnest(sel).promotion_id AS promotion_id
 FROM (SELECT transaction_id, arg_max(sel, k) AS sel FROM st GROUP BY 1)),
items AS (
 SELECT l.transaction_id, l.product_id, l.category, l.quantity, l.unit_price,
   CAST(round(l.unit_price * l.quantity, 2) AS DECIMAL(18,2)) AS item_subtotal,
   CAST(round(least(coalesce(a.al, 0), round(l.unit_price * l.quantity, 2)), 2) AS DECIMAL(18,2)) AS item_discount,
   CAST(round(greatest(0, round(l.unit_price * l.quantity, 2) - round(least(coalesce(a.al, 0), round(l.unit_price * l.quantity, 2)), 2)), 2) AS DECIMAL(18,2)) AS final_item_price
 FROM lines l LEFT JOIN (SELECT a.transaction_id, a.product_id, sum(a.allocated) AS al FROM alloc a JOIN selected s USING (transaction_id, promotion_id) GROUP BY 1, 2) a
   USING (transaction_id, product_id)),
ship AS (
 SELECT transaction_id, arg_min(promotion_id, (coalesce(min_spend, 0), promotion_id)) AS shipping_promotion_id
 FROM elig WHERE promotion_mechanic = 'free_shipping' GROUP BY 1),
chosen AS (SELECT d.* FROM disc d JOIN selected s USING (transaction_id, promotion_id)),
dsum AS (SELECT transaction_id, sum(discount) AS d,
   list({'promotion_id': CAST(promotion_id AS VARCHAR), 'promotion_type': promotion_mechanic, 'amount': CAST(discount AS DOUBLE)}
        ORDER BY CAST(promotion_id AS VARCHAR)) FILTER (WHERE discount > 0) AS applied FROM chosen GROUP BY 1),
tot AS (SELECT transaction_id, CAST(round(sum(item_subtotal), 2) AS DECIMAL(18,2)) AS cart_subtotal,
   CAST(sum(quantity) AS BIGINT) AS basket_size, count(DISTINCT product_id) AS num_unique_items FROM items GROUP BY 1),
hdr0 AS (
 SELECT h.transaction_id, h.customer_id, h.store_id, h.transaction_time, h.payment_method, t.cart_subtotal, t.basket_size, t.num_unique_items,
   CASE WHEN coalesce(round(ds.d, 2), 0) <= 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(round(ds.d, 2) AS DECIMAL(18,2)) END AS total_discount,
   CAST(round((CASE WHEN h.store_id = 0 THEN 8 ELSE 4 END) + (CASE WHEN c.region IS DISTINCT FROM st.region THEN 8
        WHEN c.area IS DISTINCT FROM st.area THEN 4 ELSE 0 END) + 1.0, 2) AS DECIMAL(18,2)) AS shipping_fee,
   sh.shipping_promotion_id, ds.applied
 FROM transactions h JOIN tot t USING (transaction_id) LEFT JOIN dsum ds USING (transaction_id)
 LEFT JOIN customers c ON c.customer_id = h.customer_id LEFT JOIN stores st ON st.store_id = h.store_id
 LEFT JOIN ship sh ON sh.transaction_id = h.transaction_id),
hdr AS (
 SELECT transaction_id, customer_id, store_id, transaction_time, payment_method, cart_subtotal, total_discount, shipping_fee,
   CASE WHEN shipping_promotion_id IS NOT NULL THEN shipping_fee ELSE CAST(0 AS DECIMAL(18,2)) END AS shipping_discount,
   CAST(round(cart_subtotal - total_discount + shipping_fee - CASE WHEN shipping_promotion_id IS NOT NULL THEN shipping_fee ELSE 0 END, 2) AS DECIMAL(18,2)) AS transaction_total,
   basket_size, num_unique_items,
   list_concat(CASE WHEN total_discount <= 0 THEN [] ELSE coalesce(applied, []) END,
     CASE WHEN shipping_promotion_id IS NOT NULL AND shipping_fee > 0 THEN [{'promotion_id': CAST(shipping_promotion_id AS VARCHAR), 'promotion_type': 'free_shipping', 'amount': CAST(shipping_fee AS DOUBLE)}] ELSE [] END) AS applied_promotions
 FROM hdr0)
"""


def chain_sql(body: str) -> str:
    return "WITH RECURSIVE " + CHAIN.strip() + "\n" + body.strip()
