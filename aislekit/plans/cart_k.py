"""K04, E12 and X-cl10, X-cl11, X-cl12, X-cl15: cart contents, their faults and the checks that find them."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import cart as C
from aislekit.operators import click_faults as CF
from aislekit.operators import clickstream as K
from aislekit.operators.faults import arith_u_sql
from aislekit.operators.sequence import carry_forward
from aislekit.plans.click_faults_e import PROF, U, _poisson
from aislekit.plans.clickstream_k import E_SQL, K_SQL, R_SQL
from aislekit.plans.derived import _memo, cut
from aislekit.plans.registry import query

MODE = "arith"
VIEWS = ("clickstreams",)

# the click table has no removes: some views take back, some home views add again, what the customer added last
CE_SQL = """SELECT event_id, customer_id, session_id, event_timestamp,
  CASE WHEN back THEN 'Remove from Cart' WHEN again THEN 'Add to Cart' ELSE event_type END AS event_type,
  CASE WHEN back OR again THEN last_add ELSE product_id END AS product_id,
  row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS event_order
FROM (SELECT *, last_add IS NOT NULL AND event_type = 'Product View' AND event_id % 4 = 1 AS back,
    last_add IS NOT NULL AND event_type = 'Home View' AND event_id % 3 = 0 AS again FROM (
  SELECT *, last_value(CASE WHEN event_type = 'Add to Cart' THEN product_id END IGNORE NULLS) OVER (
    PARTITION BY customer_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS last_add FROM clickstreams))"""
CONT_SQL = """SELECT b.event_id, a.product_id, CAST(sum(a.s) AS BIGINT) AS n FROM k b JOIN k a ON a.customer_id = b.customer_id AND a.cart_epoch = b.cart_epoch
  AND (a.event_timestamp < b.event_timestamp OR (a.event_timestamp = b.event_timestamp AND a.event_id <= b.event_id))
WHERE a.s <> 0 AND a.product_id IS NOT NULL GROUP BY 1, 2 HAVING sum(a.s) > 0"""
BUY_SQL = """SELECT b.event_id, i.product_id, i.quantity FROM (SELECT event_id, customer_id, cart_epoch - 1 AS ep FROM k WHERE event_type = 'Payment Successful') b
JOIN (SELECT customer_id, cart_epoch AS ep, product_id, CAST(sum(s) AS BIGINT) AS quantity FROM k WHERE s <> 0 AND product_id IS NOT NULL
  GROUP BY 1, 2, 3 HAVING sum(s) > 0) i USING (customer_id, ep)"""
CART = {"ce": CE_SQL, "e": E_SQL.replace("FROM clickstreams", "FROM ce"), "r": R_SQL, "k": K_SQL, "cont": CONT_SQL, "buy": BUY_SQL}

_RANK = " + ".join(f"CAST({U(40 + j)} < {U(40 + CF.STEPS.index('break_cart'))} AS INTEGER)"
                   for j in range(len(CF.STEPS)) if j != CF.STEPS.index("break_cart"))
FAULT_SQL = f"""SELECT event_id, items, CASE WHEN {U(90)} < 0.3 AND items > 0 THEN 'partial cart loss'
  WHEN {U(90)} >= 0.3 AND {U(90)} < 0.9 AND items > 0 THEN 'cart reset' WHEN {U(90)} >= 0.9 AND {U(90)} < 0.95 THEN 'cart is none'
  WHEN {U(90)} >= 0.95 AND items > 0 THEN 'cart explosion' END AS label, CAST(10 + floor({U(91)} * 21) AS BIGINT) AS extra
FROM (SELECT k.event_id, coalesce(s.items, 0) AS items, {PROF} AS prof FROM k LEFT JOIN (SELECT event_id, sum(n) AS items FROM cont GROUP BY 1) s USING (event_id))
WHERE ({_RANK}) < CASE WHEN prof = 'clean' THEN 0 WHEN prof = 'light_noise' THEN {_poisson(U(12), 1)} WHEN prof = 'moderate_noise' THEN {_poisson(U(12), 2)}
  ELSE {_poisson(U(12), 4)} END"""
_UNIT = arith_u_sql("concat_ws('-', event_id, product_id, unit)", 92)
_PICK = arith_u_sql("concat_ws('-', event_id, product_id)", 93)
BROKEN_SQL = f"""SELECT event_id, product_id, n FROM cont WHERE event_id NOT IN (SELECT event_id FROM fl WHERE label IS NOT NULL)
UNION ALL
SELECT event_id, product_id, count(*) FROM (SELECT event_id, product_id, items, row_number() OVER (PARTITION BY event_id ORDER BY {_UNIT}, product_id, unit) AS place
  FROM (SELECT event_id, product_id, unnest(range(1, n + 1)) AS unit FROM cont) JOIN fl USING (event_id) WHERE label = 'partial cart loss')
WHERE place <= floor(items / 2) GROUP BY 1, 2
UNION ALL
SELECT event_id, product_id, CASE WHEN product_id = first_value(product_id) OVER (PARTITION BY event_id ORDER BY {_PICK}, product_id) THEN n + extra ELSE n END
FROM cont JOIN fl USING (event_id) WHERE label = 'cart explosion'"""
BROKEN = {**CART, "fl": FAULT_SQL, "brk": BROKEN_SQL}
CHANGE_SQL = """SELECT session_id, event_order, product_id, sum(d) AS d FROM (
  SELECT session_id, event_order, b.product_id, n AS d FROM brk b JOIN ce USING (event_id)
  UNION ALL SELECT session_id, event_order + 1, b.product_id, -n FROM brk b JOIN ce USING (event_id)) GROUP BY 1, 2, 3 HAVING sum(d) <> 0"""
CHANGED = {**BROKEN, "ch": CHANGE_SQL}


def cart_events(t):
    def build():
        e = t.view("clickstreams").withColumn("__add", F.when(F.col("event_type") == "Add to Cart", F.col("product_id")))
        e = carry_forward(e, ["customer_id"], ["event_timestamp", "event_id"], "__add", "__last")
        known = F.col("__last").isNotNull()
        back = known & (F.col("event_type") == "Product View") & (F.col("event_id") % 4 == 1)
        again = known & (F.col("event_type") == "Home View") & (F.col("event_id") % 3 == 0)
        e = e.select("event_id", "customer_id", "session_id", "event_timestamp",
                     F.when(back, "Remove from Cart").when(again, "Add to Cart").otherwise(F.col("event_type")).alias("event_type"),
                     F.when(back | again, F.col("__last")).otherwise(F.col("product_id")).alias("product_id"))
        return C.positions(K.cart_replay(K.event_order(e)))
    return cut(t, "__cart_events", build)


def contents(t):
    return cut(t, "__cart_contents", lambda: C.cart_contents(cart_events(t)))


def broken(t):
    def build():
        hits = CF.with_budget(cart_events(t), MODE).select("event_id", F.col("__sel_break_cart").alias("hit"))
        after, labels = C.break_carts(hits, contents(t), MODE)
        return cut(t, "__broken_contents", lambda: after), labels
    return _memo(t, "__broken_carts", build)


@query("k04_cart_changes", VIEWS, """
SELECT event_id, product_id, s AS change, CAST(sum(s) OVER (PARTITION BY customer_id, cart_epoch, product_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS quantity
FROM k WHERE s <> 0 AND product_id IS NOT NULL""", CART)
def k04_changes(t):
    """Signed change of each add and remove, and the product's running count in the cart."""
    return C.cart_changes(cart_events(t)).select("event_id", "product_id", "change", "quantity")


@query("k04_cart_contents", VIEWS, "SELECT event_id, product_id, n FROM cont", CART)
def k04_contents(t):
    """The cart after every event, as (event, product, count) rows."""
    return contents(t)


@query("k04_purchased_rows", VIEWS, "SELECT event_id, product_id, quantity FROM buy", CART)
def k04_purchased(t):
    """Products and quantities that each successful payment buys."""
    return C.purchased_rows(cart_events(t))


@query("e12_cart_contents", VIEWS, "SELECT event_id, product_id, n FROM brk", BROKEN)
def e12_contents(t):
    """Cart contents after partial losses, resets, missing carts and explosions."""
    return broken(t)[0]


@query("e12_cart_labels", VIEWS, """
SELECT event_id, label, CAST(CASE label WHEN 'partial cart loss' THEN floor(items / 2) WHEN 'cart reset' THEN 0 WHEN 'cart explosion' THEN items + extra END AS BIGINT) AS items
FROM fl WHERE label IS NOT NULL""", BROKEN)
def e12_labels(t):
    """Events whose cart was broken, how, and how many items it holds then."""
    return broken(t)[1]


def _wrong_change_sql(event_type: str, step: int) -> str:
    return f"""SELECT event_id, CAST(coalesce(sum(ch.d) FILTER (ch.product_id = ce.product_id), 0) AS BIGINT) AS own_change,
  count(*) FILTER (ch.product_id <> ce.product_id) AS other_changes
FROM ce LEFT JOIN ch ON ch.session_id = ce.session_id AND ch.event_order = ce.event_order
WHERE event_type = '{event_type}' AND ce.product_id IS NOT NULL AND ce.event_order > 1 GROUP BY 1
HAVING coalesce(sum(ch.d) FILTER (ch.product_id = ce.product_id), 0) <> {step} OR count(*) FILTER (ch.product_id <> ce.product_id) > 0"""


@query("x_cl10_cart_contains_added_products", VIEWS, _wrong_change_sql("Add to Cart", 1), CHANGED)
def x_cl10(t):
    """Adds after which the (faulted) cart doesn't hold one more of the product, or another product changed."""
    return C.wrong_cart_changes(cart_events(t), broken(t)[0], "Add to Cart")


@query("x_cl11_cart_does_not_contain_removed_products", VIEWS, _wrong_change_sql("Remove from Cart", -1), CHANGED)
def x_cl11(t):
    """Removes after which the (faulted) cart doesn't hold one less of the product, or another product changed."""
    return C.wrong_cart_changes(cart_events(t), broken(t)[0], "Remove from Cart")


@query("x_cl12_cart_size_matches_cart_content", VIEWS, """
SELECT k.event_id, CAST(k.cart_size AS BIGINT) AS cart_size, CAST(coalesce(i.items, 0) AS BIGINT) AS items FROM k
LEFT JOIN (SELECT event_id, sum(n) AS items FROM brk GROUP BY 1) i USING (event_id) WHERE k.cart_size IS DISTINCT FROM coalesce(i.items, 0)""", BROKEN)
def x_cl12(t):
    """Events whose cart size isn't the number of items in the (faulted) cart."""
    return C.cart_size_mismatches(cart_events(t), broken(t)[0])


@query("x_cl15_purchased_items_subset_of_cart", VIEWS, """
SELECT buy.event_id, buy.product_id FROM buy JOIN ce USING (event_id) WHERE NOT EXISTS (SELECT 1 FROM brk JOIN ce c2 ON c2.event_id = brk.event_id
  WHERE c2.session_id = ce.session_id AND c2.event_order + 1 = ce.event_order AND brk.product_id = buy.product_id)""", BROKEN)
def x_cl15(t):
    """Bought products that the session's previous (faulted) cart doesn't hold."""
    return C.purchases_outside_cart(cart_events(t), broken(t)[0], C.purchased_rows(cart_events(t)))
