"""K01-K24 (+F07, X-cl*): clickstream sessions and their checks."""

from __future__ import annotations


from pyspark.sql import functions as F

from aislekit import functions as fx
from aislekit.operators import checks as X
from aislekit.operators import clickstream as K
from aislekit.operators.sequence import running_sum
from aislekit.plans.derived import _memo, hot_clicks
from aislekit.plans.registry import query

CS = ("clickstreams",)
E_SQL = """SELECT *, CASE WHEN event_type = 'Payment Successful' THEN 1 ELSE 0 END AS buy,
  CASE WHEN event_type = 'Add to Cart' THEN 1 WHEN event_type = 'Remove from Cart' THEN -1 ELSE 0 END AS s FROM clickstreams"""
R_SQL = """SELECT *, sum(buy) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS cart_epoch FROM e"""
K_SQL = """SELECT *, sum(s) OVER (PARTITION BY customer_id, cart_epoch ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS cart_size FROM r"""
PI_SQL = """SELECT b.event_id, coalesce(i.items, CAST([] AS VARCHAR[])) AS purchased_items FROM (SELECT event_id, customer_id, cart_epoch - 1 AS ep FROM k WHERE event_type = 'Payment Successful') b
LEFT JOIN (SELECT customer_id, cart_epoch AS ep, list(pid ORDER BY pid) AS items FROM (
   SELECT customer_id, cart_epoch, CAST(product_id AS VARCHAR) AS pid, unnest(range(CAST(n AS BIGINT))) AS _i FROM (
     SELECT customer_id, cart_epoch, product_id, sum(s) AS n FROM k WHERE event_type IN ('Add to Cart', 'Remove from Cart') GROUP BY 1, 2, 3) WHERE n > 0)
   GROUP BY 1, 2) i USING (customer_id, ep)"""
ENR_SQL = """SELECT k.event_id, k.session_id, k.customer_id, k.event_type, k.event_timestamp, k.product_id, p.product_name, p.category, k.scroll_depth,
  row_number() OVER (PARTITION BY k.session_id ORDER BY k.event_timestamp, k.event_id) AS event_order,
  CASE WHEN count(*) OVER (PARTITION BY k.session_id) = 1 THEN 1 ELSE 0 END AS bounce_flag, k.cart_size,
  coalesce(pi.purchased_items, CAST([] AS VARCHAR[])) AS purchased_items,
  CASE k.event_type WHEN 'Home View' THEN '/home' WHEN 'Cart View' THEN '/cart' WHEN 'Checkout Start' THEN '/checkout'
    WHEN 'Payment Attempt' THEN '/payment' WHEN 'Payment Successful' THEN '/payment/success' WHEN 'Payment Failed' THEN '/payment/fail'
    WHEN 'Product View' THEN CASE WHEN k.product_id IS NOT NULL THEN '/product/' || CAST(k.product_id AS VARCHAR) ELSE '/product/{product_id}' END
    WHEN 'Add to Cart' THEN CASE WHEN k.product_id IS NOT NULL THEN '/add_to_cart/' || CAST(k.product_id AS VARCHAR) ELSE '/add_to_cart/{product_id}' END
    WHEN 'Remove from Cart' THEN CASE WHEN k.product_id IS NOT NULL THEN '/remove_from_cart/' || CAST(k.product_id AS VARCHAR) ELSE '/remove_from_cart/{product_id}' END
    ELSE '' END AS page
FROM k LEFT JOIN products p USING (product_id) LEFT JOIN pi USING (event_id)"""
KCTE = {"e": E_SQL, "r": R_SQL, "k": K_SQL}
ENR = {"e": E_SQL, "r": R_SQL, "k": K_SQL, "pi": PI_SQL, "enr": ENR_SQL}


def enriched(t):
    return _memo(t, "__enriched", lambda: K.enrich_clickstream(t.view("clickstreams"), t.view("products"), hot_clicks(t)))


@query("k01_sort_sessions", CS, "SELECT session_id, event_timestamp, event_id FROM clickstreams ORDER BY 1, 2, 3")
def k01(t):
    """Click events sorted by session, time and id."""
    return K.sort_sessions(t.view("clickstreams")).select("session_id", "event_timestamp", "event_id")


@query("k02_event_order", CS, """
SELECT event_id, row_number() OVER w AS event_order, session_id || '_' || CAST(row_number() OVER w - 1 AS VARCHAR) AS clickstream_id
FROM clickstreams WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)""")
def k02(t):
    """1-based event order per session and the clickstream id."""
    return K.event_order(t.view("clickstreams")).select("event_id", "event_order", "clickstream_id")


@query("k03_bounce_flag", CS, "SELECT event_id, CASE WHEN count(*) OVER (PARTITION BY session_id) = 1 THEN 1 ELSE 0 END AS bounce_flag FROM clickstreams")
def k03(t):
    """Bounce flag on events of one-event sessions."""
    return K.bounce_flags(t.view("clickstreams")).select("event_id", "bounce_flag")


@query("k04_cart_replay", CS, "SELECT event_id, cart_epoch, cart_size FROM k", KCTE)
def k04(t):
    """Running cart size per customer (emptied by each purchase)."""
    return K.cart_replay(t.view("clickstreams")).select("event_id", F.col("cart_epoch").cast("long").alias("cart_epoch"), "cart_size")


@query("k04_purchased_items", CS, PI_SQL.replace("coalesce(i.items, CAST([] AS VARCHAR[]))", "coalesce(i.items, CAST([] AS VARCHAR[]))"),
       {"e": E_SQL, "r": R_SQL, "k": K_SQL})
def k04b(t):
    """Items bought at each successful payment (the cart it empties)."""
    return K.purchased_items(K.cart_replay(t.view("clickstreams")))


_NEXT = "lead(event_type) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id)"


def _allowed_values() -> str:
    return "VALUES " + ", ".join(f"('{a}', '{b}')" for a, m in K.VALID_EVENT_TRANSITIONS.items() for b in m)


@query("k05_transition_matrix", CS, f"""
WITH obs AS (SELECT event_type AS from_event, nx AS to_event, count(*) AS n FROM (SELECT event_type, {_NEXT} AS nx FROM clickstreams) WHERE nx IS NOT NULL GROUP BY 1, 2),
al AS (SELECT * FROM ({_allowed_values()}) v(from_event, to_event)),
a AS (SELECT coalesce(o.from_event, al.from_event) AS from_event, coalesce(o.to_event, al.to_event) AS to_event, CAST(coalesce(o.n, 0) AS BIGINT) AS n
      FROM obs o FULL JOIN al ON o.from_event = al.from_event AND o.to_event = al.to_event)
SELECT from_event, to_event, n, round(coalesce(n / nullif(sum(n) OVER (PARTITION BY from_event), 0), 0.0), 6) AS share FROM a""")
def k05(t):
    """Observed next-event shares (allowed but unseen pairs at zero)."""
    return K.transition_matrix(t.view("clickstreams"))


@query("k06_invalid_transitions", CS, f"""
SELECT event_type AS from_event, nx AS to_event, count(*) AS n FROM (SELECT event_type, {_NEXT} AS nx FROM clickstreams)
WHERE nx IS NOT NULL AND (event_type, nx) NOT IN (SELECT * FROM ({_allowed_values()}) v(a, b)) GROUP BY 1, 2""")
def k06(t):
    """Observed event pairs the allowed transition table does not have."""
    return K.invalid_transitions(t.view("clickstreams"))


@query("k13_cart_progress", CS, "SELECT event_id, round(least(cart_size / 10.0, 1.0), 6) AS cart_progress FROM k", KCTE)
def k13(t):
    """Cart progress against a 10-item target."""
    r = K.cart_replay(t.view("clickstreams"))
    return r.select("event_id", F.round(K.cart_progress(F.col("cart_size"), F.lit(10.0)), 6).alias("cart_progress"))


@query("k14_time_on_page", CS, """
SELECT event_id, epoch_us(lead(event_timestamp) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id)) / 1e6 - epoch_us(event_timestamp) / 1e6 AS time_on_page
FROM clickstreams""")
def k14(t):
    """Seconds from each event to the next one in its session."""
    return K.time_on_page(t.view("clickstreams")).select("event_id", F.round("time_on_page", 6).alias("time_on_page"))


_STARTS = "SELECT customer_id, session_id, min(event_timestamp) AS session_start FROM clickstreams GROUP BY 1, 2"
_GAPS = f"""SELECT customer_id, session_id, g AS gap_seconds,
  CASE WHEN g IS NULL THEN NULL WHEN g < 86400 THEN 'short' WHEN g < 86400 * 8 THEN 'weekly' ELSE 'long' END AS gap_band
FROM (SELECT *, CASE WHEN ps IS NOT NULL THEN least((epoch_us(session_start) - epoch_us(ps)) // 1000000, 5184000) END AS g
      FROM (SELECT *, lag(session_start) OVER (PARTITION BY customer_id ORDER BY session_start, session_id) AS ps FROM ({_STARTS})))"""


@query("k15_session_gap", CS, _GAPS)
def k15(t):
    """Hours since the customer's previous session, capped, with a band."""
    return K.session_gaps(t.view("clickstreams"))


@query("k16_inactive_gap", ("clickstreams", "customers"), f"""
SELECT c.customer_segment, round(avg(ln(g.gap_seconds / 86400)), 6) AS log_mean, round(stddev_samp(ln(g.gap_seconds / 86400)), 6) AS log_std, count(*) AS gaps
FROM ({_GAPS}) g JOIN customers c USING (customer_id) WHERE g.gap_seconds >= 86400 GROUP BY 1""")
def k16(t):
    """Log-normal summary of inactive days by segment."""
    return K.inactive_gap_summary(K.session_gaps(t.view("clickstreams")), t.view("customers"))


@query("k17_activity_multiplier", CS, "SELECT customer_id, least(greatest(count(DISTINCT session_id), 1), 10) AS activity_multiplier FROM clickstreams GROUP BY 1")
def k17(t):
    """Sessions per customer clipped to 1-10."""
    return K.activity_multiplier(t.view("clickstreams"))


@query("k18_timestamp_weights", CS, """
SELECT day_type, pay_cycle, time_of_day, count(*) AS events, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (
  SELECT CASE WHEN isodow(event_timestamp) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
    CASE WHEN day(event_timestamp) IN (1, 15) THEN 'Payday' WHEN day(event_timestamp) IN (28, 29, 30, 31, 2) THEN 'Payday Spillover' END AS pay_cycle,
    CASE WHEN hour(event_timestamp) < 5 THEN 'Late Night' WHEN hour(event_timestamp) < 8 THEN 'Early Morning' WHEN hour(event_timestamp) < 12 THEN 'Morning'
      WHEN hour(event_timestamp) < 17 THEN 'Afternoon' WHEN hour(event_timestamp) < 21 THEN 'Evening' ELSE 'Night' END AS time_of_day
  FROM clickstreams) GROUP BY 1, 2, 3""")
def k18(t):
    """Share of events by day type, pay cycle and time of day."""
    c = t.view("clickstreams")
    ts = F.col("event_timestamp")
    g = c.groupBy(fx.day_type(ts).alias("day_type"), fx.pay_cycle(ts).alias("pay_cycle"), fx.time_of_day(ts).alias("time_of_day")) \
        .agg(F.count(F.lit(1)).alias("events"))
    from pyspark.sql import Window
    tot = F.sum("events").over(Window.partitionBy())  # over the grouped result: at most 2 x 3 x 6 rows
    return g.select("day_type", "pay_cycle", "time_of_day", "events", F.round(F.col("events") / tot, 6).alias("share"))


@query("k20_session_flags", ("clickstreams", "campaign_exposures", "campaigns"), f"""
WITH s AS ({_STARTS}), a AS (SELECT DISTINCT campaign_id, customer_id, assignment_group FROM campaign_exposures),
j AS (SELECT s.session_id, a.campaign_id, a.assignment_group FROM s JOIN a USING (customer_id) JOIN campaigns c USING (campaign_id)
      WHERE c.start_date <= s.session_start AND c.end_date >= s.session_start)
SELECT s.session_id, coalesce(list_sort(list_distinct(list(j.campaign_id) FILTER (WHERE j.campaign_id IS NOT NULL))), CAST([] AS BIGINT[])) AS campaign_ids,
  coalesce(bool_or(j.assignment_group = 'Treatment'), false) AS has_treatment_campaign,
  coalesce(bool_or(j.assignment_group = 'Control'), false) AS has_control_campaign
FROM s LEFT JOIN j USING (session_id) GROUP BY 1""")
def k20(t):
    """Campaigns active for each session's customer, and Treatment / Control flags."""
    s = K.session_starts(t.view("clickstreams"))
    return K.session_flags(s, t.view("campaign_exposures"), t.view("campaigns"))


@query("k21_location_match", ("transactions", "customers", "stores"), """
SELECT t.transaction_id, CASE WHEN c.area IS NOT DISTINCT FROM st.area AND c.area IS NOT NULL THEN 'home_area'
  WHEN c.region IS NOT DISTINCT FROM st.region AND c.region IS NOT NULL THEN 'same_region' ELSE 'elsewhere' END AS location
FROM transactions t LEFT JOIN customers c USING (customer_id) LEFT JOIN stores st ON st.store_id = t.store_id""")
def k21(t):
    """Where each purchase happened relative to the customer's home area."""
    c = t.view("customers").select("customer_id", F.col("area").alias("ca"), F.col("region").alias("cr"))
    s = t.view("stores").select("store_id", F.col("area").alias("sa"), F.col("region").alias("sr"))
    j = t.view("transactions").join(c, "customer_id", "left").join(s, "store_id", "left")
    return j.select("transaction_id", K.location_match(F.col("ca"), F.col("cr"), F.col("sa"), F.col("sr")).alias("location"))


@query("k22_next_category", ("clickstreams", "products"), """
WITH e AS (SELECT c.session_id, c.event_timestamp, c.event_id, p.category FROM clickstreams c JOIN products p USING (product_id) WHERE p.category IS NOT NULL),
o AS (SELECT category AS from_category, nx AS to_category, count(*) AS n FROM (SELECT category, lead(category) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS nx FROM e)
      WHERE nx IS NOT NULL GROUP BY 1, 2)
SELECT from_category, to_category, n, round(n / sum(n) OVER (PARTITION BY from_category), 6) AS share FROM o""")
def k22(t):
    """Category -> next category transitions inside sessions."""
    e = t.view("clickstreams").join(t.view("products").select("product_id", "category"), "product_id")
    return K.next_category(e)


@query("f07_resolve_page", ("clickstreams", "products"), "SELECT event_id, page FROM enr", ENR)
def f07(t):
    """Page of each click event from its template, product and category."""
    return enriched(t).select("event_id", "page")


# ---- clickstream output checks (on the enriched table) ----------------------

def _v(ok):
    return X.violates(ok)


CL_ROW = {
    "x_cl01_timestamps_within_data_window": (
        lambda: (F.col("event_timestamp") <= X._end_of_day("2024-12-31")) & (F.col("event_timestamp") >= X.ts("2024-01-01")),
        "event_timestamp <= TIMESTAMP '2024-12-31 23:59:59' AND event_timestamp >= TIMESTAMP '2024-01-01'"),
    "x_cl02_event_timestamp_not_in_future": (lambda: F.col("event_timestamp") <= X.ts(X.DEFAULT_NOW), f"event_timestamp <= TIMESTAMP '{X.DEFAULT_NOW}'"),
    "x_cl08_product_name_valid": (lambda: F.col("product_id").isNull() | (F.col("product_name").isNotNull() & (F.length("product_name") > 0)),
                                  "product_id IS NULL OR (product_name IS NOT NULL AND length(product_name) > 0)"),
    "x_cl14_purchased_items_only_on_payment_success": (lambda: (F.col("event_type") == "Payment Successful") | (F.size("purchased_items") == 0),
                                                       "event_type = 'Payment Successful' OR len(purchased_items) = 0"),
    "x_cl16_event_remove_from_cart": (lambda: (F.col("event_type") != "Remove from Cart") | F.col("page").contains("remove_from_cart"),
                                      "event_type <> 'Remove from Cart' OR contains(page, 'remove_from_cart')"),
    "x_cl17_event_add_to_cart": (lambda: (F.col("event_type") != "Add to Cart") | (F.col("page").contains("add_to_cart") & (F.col("cart_size") > 0)),
                                 "event_type <> 'Add to Cart' OR (contains(page, 'add_to_cart') AND cart_size > 0)"),
    "x_cl18_event_product_view": (lambda: (F.col("event_type") != "Product View") | F.col("page").contains("product"),
                                  "event_type <> 'Product View' OR contains(page, 'product')"),
    "x_cl19_event_category_view": (lambda: (F.col("event_type") != "Category View") | (F.col("category").isNotNull() & F.col("page").contains("category")),
                                   "event_type <> 'Category View' OR (category IS NOT NULL AND contains(page, 'category'))"),
    "x_cl20_event_search_view": (lambda: (F.col("event_type") != "Search View") | F.col("page").contains("search"),
                                 "event_type <> 'Search View' OR contains(page, 'search')"),
    "x_cl21_event_payment_successful": (lambda: (F.col("event_type") != "Payment Successful")
                                        | ((F.size("purchased_items") > 0) & F.col("page").contains("payment/success")),
                                        "event_type <> 'Payment Successful' OR (len(purchased_items) > 0 AND contains(page, 'payment/success'))"),
    "x_cl22_event_home_view": (lambda: (F.col("event_type") != "Home View") | F.col("page").contains("home"),
                               "event_type <> 'Home View' OR contains(page, 'home')"),
    "x_cl23_event_cart_view": (lambda: (F.col("event_type") != "Cart View") | F.col("page").contains("cart"),
                               "event_type <> 'Cart View' OR contains(page, 'cart')"),
    "x_cl24_event_checkout": (lambda: ~F.col("event_type").isin("Checkout Start", "Payment Attempt", "Payment Failed")
                              | ((F.col("cart_size") > 0) & (F.size("purchased_items") == 0)
                                 & (F.col("page").contains("checkout") | F.col("page").contains("payment"))),
                              "event_type NOT IN ('Checkout Start', 'Payment Attempt', 'Payment Failed') OR (cart_size > 0 AND len(purchased_items) = 0"
                              " AND (contains(page, 'checkout') OR contains(page, 'payment')))"),
}


def _reg_cl(name, spark_ok, sql_ok):
    def fn(t, _ok=spark_ok):
        return enriched(t).where(_v(_ok())).select("event_id")
    fn.__doc__ = f"Click events violating {name}."
    query(name, ("clickstreams", "products"), f"SELECT event_id FROM enr WHERE NOT coalesce({sql_ok}, false)", ENR)(fn)


for _n, (_s, _q) in CL_ROW.items():
    _reg_cl(_n, _s, _q)


@query("x_cl03_only_digital_customers", ("clickstreams", "customers"), """
SELECT event_id FROM clickstreams WHERE customer_id NOT IN (SELECT customer_id FROM customers WHERE customer_type IN ('Online Only', 'Omnichannel'))
  OR customer_id IS NULL""")
def x_cl03(t):
    """Click events of customers who are not Online Only / Omnichannel."""
    d = t.view("customers").where(F.col("customer_type").isin(X.DIGITAL_TYPES)).select("customer_id")
    return t.view("clickstreams").join(d, "customer_id", "left_anti").select("event_id")


@query("x_cl04_has_treatment_campaign", ("clickstreams", "campaign_exposures", "campaigns"), f"""
WITH s AS ({_STARTS}), a AS (SELECT DISTINCT campaign_id, customer_id, assignment_group FROM campaign_exposures),
j AS (SELECT s.session_id, a.campaign_id, a.assignment_group FROM s JOIN a USING (customer_id) JOIN campaigns c USING (campaign_id)
      WHERE c.start_date <= s.session_start AND c.end_date >= s.session_start),
f AS (SELECT s.session_id, count(j.campaign_id) AS n, coalesce(bool_or(j.assignment_group = 'Treatment'), false) AS tr FROM s LEFT JOIN j USING (session_id) GROUP BY 1)
SELECT session_id FROM f WHERE NOT coalesce(NOT tr OR n > 0, false)""")
def x_cl04(t):
    """Sessions flagged Treatment without campaign ids."""
    f = K.session_flags(K.session_starts(t.view("clickstreams")), t.view("campaign_exposures"), t.view("campaigns"))
    return f.where(_v(~F.col("has_treatment_campaign") | (F.size("campaign_ids") > 0))).select("session_id")


@query("x_cl05_bounce_flag", ("clickstreams", "products"), """
SELECT event_id FROM enr WHERE NOT coalesce(bounce_flag = 0 OR event_order = 1, false)
UNION ALL SELECT event_id FROM enr WHERE bounce_flag = 1 AND session_id IN (SELECT session_id FROM enr GROUP BY 1 HAVING count(*) > 1)""", ENR)
def x_cl05(t):
    """Bounce flags on a non-first event or on a multi-event session."""
    e = enriched(t)
    multi = e.groupBy("session_id").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("session_id")
    a = e.where(_v((F.col("bounce_flag") == 0) | (F.col("event_order") == 1))).select("event_id")
    b = e.where(F.col("bounce_flag") == 1).join(multi, "session_id", "left_semi").select("event_id")
    return a.unionAll(b)


@query("x_cl06_session_has_entry_point", CS, """
SELECT session_id FROM clickstreams GROUP BY 1 HAVING NOT bool_or(event_type IN ('Home View', 'Search View', 'Category View', 'Product View'))""")
def x_cl06(t):
    """Sessions without an entry-point view event."""
    return (t.view("clickstreams").groupBy("session_id").agg(F.bool_or(F.col("event_type").isin(K.ENTRY_EVENTS)).alias("__ok"))
            .where(~F.col("__ok")).select("session_id"))


@query("x_cl07_session_order_contract", ("clickstreams", "products"), """
SELECT event_id FROM (SELECT event_id, event_order, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS rk FROM enr)
WHERE event_order <> rk""", ENR)
def x_cl07(t):
    """Events whose order differs from their rank by time in the session."""
    e = enriched(t).select("session_id", "event_timestamp", "event_id", "event_order").withColumn("__one", F.lit(1))
    r = running_sum(e, ["session_id"], ["event_timestamp", "event_id"], "__one", "__rk", bucket=K.hour_bucket())
    return r.where(F.col("event_order") != F.col("__rk")).select("event_id")


@query("x_cl09_product_category_consistency", ("clickstreams", "products"), """
SELECT e.event_id FROM enr e JOIN products p USING (product_id) WHERE e.product_id IS NOT NULL AND NOT coalesce(e.category = p.category, false)""", ENR)
def x_cl09(t):
    """Events whose category differs from the product's master category."""
    p = t.view("products").select("product_id", F.col("category").alias("__mc"))
    return enriched(t).where(F.col("product_id").isNotNull()).join(p, "product_id").where(
        _v(F.col("category") == F.col("__mc"))).select("event_id")


@query("x_cl13_cart_size_changes", ("clickstreams", "products"), """
SELECT event_id FROM (SELECT *, lag(cart_size) OVER (PARTITION BY session_id ORDER BY event_order) AS pc FROM enr) WHERE pc IS NOT NULL AND NOT coalesce(
  CASE WHEN event_type IN ('Remove from Cart', 'Payment Successful') THEN cart_size < pc AND cart_size >= 0
       WHEN event_type = 'Add to Cart' THEN cart_size > pc ELSE cart_size = pc END, false)""", ENR)
def x_cl13(t):
    """Events whose cart size moves the wrong way for the event type."""
    from aislekit.operators.sequence import neighbour
    n = neighbour(enriched(t), ["session_id"], ["event_order"], ["cart_size"], "prev",
                  bucket=F.floor(F.col("event_order") / 1000))
    pc, c = F.col("prev_cart_size"), F.col("cart_size")
    ok = (F.when(F.col("event_type").isin("Remove from Cart", "Payment Successful"), (c < pc) & (c >= 0))
          .when(F.col("event_type") == "Add to Cart", c > pc).otherwise(c == pc))
    return n.where(pc.isNotNull() & _v(ok)).select("event_id")


@query("x_cl25_payment_sequence", ("clickstreams", "products"), """
SELECT event_id FROM (SELECT *, coalesce(sum(CASE WHEN event_type = 'Checkout Start' THEN 1 ELSE 0 END) OVER w, 0) AS chk,
  coalesce(sum(CASE WHEN event_type = 'Payment Attempt' THEN 1 ELSE 0 END) OVER w, 0) AS att FROM enr
  WINDOW w AS (PARTITION BY session_id ORDER BY event_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
WHERE (event_type = 'Payment Attempt' AND chk = 0) OR (event_type IN ('Payment Successful', 'Payment Failed') AND att = 0)""", ENR)
def x_cl25(t):
    """Payment attempts before any checkout, or results before any attempt."""
    e = enriched(t).withColumn("__c", F.when(F.col("event_type") == "Checkout Start", 1).otherwise(0)) \
        .withColumn("__a", F.when(F.col("event_type") == "Payment Attempt", 1).otherwise(0))
    b = F.floor(F.col("event_order") / 1000)
    e = running_sum(e, ["session_id"], ["event_order"], "__c", "__chk", bucket=b)
    e = running_sum(e, ["session_id"], ["event_order"], "__a", "__att", bucket=b)
    seen_c = F.col("__chk") - F.col("__c")
    seen_a = F.col("__att") - F.col("__a")
    bad = (((F.col("event_type") == "Payment Attempt") & (seen_c == 0))
           | (F.col("event_type").isin("Payment Successful", "Payment Failed") & (seen_a == 0)))
    return e.where(bad).select("event_id")


