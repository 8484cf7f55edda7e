"""Seeded fault injection, fault plans, detectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import faults as E
from aislekit.operators import quality as Qd
from aislekit.operators.profile import ERR
from aislekit.plans.basket_b import priced
from aislekit.plans.fault_plans import DETECTORS, PLANS
from aislekit.plans.registry import query
from aislekit.plans.sql_basket import CHAIN, VIEWS as BASKET_VIEWS
from aislekit.plans.sql_detect import labels_sql

MODE = "arith"  # oracle-reproducible draws in the registered queries


def _u_sql(key: str, seed: int) -> str:
    return E.arith_u_sql(key, seed)


@query("e01_add_error", ("customers",), f"""
SELECT customer_id, CASE WHEN loyalty_points < 0 THEN ['negative loyalty points'] ELSE CAST([] AS VARCHAR[]) END AS error_types FROM customers""")
def e01(t):
    """Label rows with negative points once (cap 4)."""
    c = t.view("customers").withColumn(ERR, F.array().cast("array<string>"))
    return c.select("customer_id", E.add_error(F.col(ERR), F.col("loyalty_points") < 0, "negative loyalty points").alias(ERR))


@query("e02_inject_nulls", ("customers",), f"""
SELECT customer_id, CASE WHEN h THEN NULL ELSE email END AS email,
  CASE WHEN h THEN ['missing email'] ELSE CAST([] AS VARCHAR[]) END AS error_types
FROM (SELECT *, customer_type IN ('Online Only', 'Omnichannel') AND {_u_sql('customer_id', 5)} < 0.06 AS h FROM customers)""")
def e02(t):
    """Null 6% of digital customers' emails (seeded), labelled."""
    c = t.view("customers")
    d = E.inject_nulls(c, "email", 0.06, "missing email", F.col("customer_id"), 5,
                       F.col("customer_type").isin("Online Only", "Omnichannel"), MODE)
    return d.select("customer_id", "email", ERR)


@query("e03_inject_whitespace", ("customers",), f"""
SELECT customer_id, CASE WHEN h THEN CASE WHEN k = 0 THEN '  ' || email WHEN k = 1 THEN email || '   ' WHEN k = 2 THEN upper(email) ELSE lower(email) END
  ELSE email END AS email, CASE WHEN h THEN ['email formatting anomaly'] ELSE CAST([] AS VARCHAR[]) END AS error_types
FROM (SELECT *, email IS NOT NULL AND {_u_sql('customer_id', 7)} < 0.08 AS h, floor({_u_sql('customer_id', 8)} * 4) AS k FROM customers)""")
def e03(t):
    """Whitespace / case noise on 8% of emails (seeded), labelled."""
    d = E.inject_whitespace(t.view("customers"), "email", 0.08, "email formatting anomaly", F.col("customer_id"), 7, MODE)
    return d.select("customer_id", "email", ERR)


@query("e04_duplicate_rows", ("transactions",), f"""
SELECT transaction_id, CAST([] AS VARCHAR[]) AS error_types FROM transactions
UNION ALL SELECT transaction_id, ['duplicate row'] FROM transactions WHERE {_u_sql('transaction_id', 9)} < 0.02""")
def e04(t):
    """2% of transactions copied (seeded); copies labelled."""
    d = E.duplicate_rows(t.view("transactions"), 0.02, "duplicate row", F.col("transaction_id"), 9, MODE)
    return d.select("transaction_id", ERR)


_SKEY_SQL = "customer_id * 10000 + datediff('day', DATE '2024-01-01', CAST(event_timestamp AS DATE))"


def _skey():
    return F.col("customer_id") * 10000 + F.datediff(F.to_date("event_timestamp"), F.lit("2024-01-01").cast("date"))


def _profile_sql(u: str) -> str:
    return f"CASE WHEN {u} < 0.65 THEN 'clean' WHEN {u} < 0.85 THEN 'light_noise' WHEN {u} < 0.95 THEN 'moderate_noise' ELSE 'heavy_corruption' END"


@query("e05_session_profile", ("clickstreams",), f"""
SELECT DISTINCT session_id, {_profile_sql(_u_sql('sk', 11))} AS profile FROM (SELECT *, {_SKEY_SQL} AS sk FROM clickstreams)""")
def e05(t):
    """Noise profile of every click session (seeded by session)."""
    c = t.view("clickstreams")
    return c.select("session_id", E.session_profile(_skey(), 11, MODE).alias("profile")).distinct()


def _poisson_sql(u: str, mean: float) -> str:
    from math import exp, factorial
    parts, cdf = [], 0.0
    for k in range(21):
        cdf += exp(-mean) * mean ** k / factorial(k)
        parts.append(f"WHEN {u} < {cdf!r} THEN {k}")
    return "CASE " + " ".join(parts) + " ELSE 20 END"


@query("e06_corruption_budget", ("clickstreams",), f"""
SELECT event_id, CASE WHEN p = 'clean' THEN 0 WHEN p = 'light_noise' THEN {_poisson_sql('u', 1)} WHEN p = 'moderate_noise' THEN {_poisson_sql('u', 2)}
  ELSE {_poisson_sql('u', 4)} END AS budget
FROM (SELECT event_id, {_profile_sql(_u_sql(_SKEY_SQL, 11))} AS p, {_u_sql('event_id', 12)} AS u FROM clickstreams)""")
def e06(t):
    """Corruption budget of every event from its session profile (Poisson)."""
    c = t.view("clickstreams")
    return c.select("event_id", E.corruption_budget(E.session_profile(_skey(), 11, MODE), F.col("event_id"), 12, MODE).alias("budget"))


def _register_plan(table: str, spec: dict):
    tid, key, steps = spec["id"], spec["key"], spec["steps"]
    basket = table in ("transactions", "transaction_items")
    src_sql = {"transactions": "hdr", "transaction_items": "items"}.get(table, table)
    rk = spec.get("rk")

    def faulted(t):
        base = {"transactions": lambda: priced(t)["transactions"].drop("applied_promotions"),
                "transaction_items": lambda: priced(t)["items"]}.get(table, lambda: t.view(table))()
        if rk:
            base = base.withColumn("__rk", spec["rk_spark"]())
        return E.apply_plan(base, steps, key, MODE)

    from aislekit.plans.fault_plans import PLANS as _P  # noqa: F401
    base_sql = f"SELECT *{', ' + rk + ' AS __rk' if rk else ''} FROM {src_sql}"
    if table == "transactions":
        base_sql = f"SELECT * EXCLUDE (applied_promotions) FROM {src_sql}"
    ctes, last = E.plan_sql(f"{table}_b", steps, key, [])
    ctes = {f"{table}_b": base_sql, **ctes}
    key_cols = {"customers": "customer_id", "products": "product_id", "store_catalogues": "store_id, product_id",
                "product_content_quality": "content_version_id", "campaigns": "campaign_id", "campaign_exposures": "event_id",
                "bundle_pricings": "bundle_pricing_id", "promotions": "promotion_id", "transactions": "transaction_id",
                "transaction_items": "__rk", "product_reviews": "review_id"}[table]
    changed = sorted({s.col for s in steps if s.col} | {s.extra.get("with") for s in steps if s.extra.get("with")})
    cols = ", ".join([key_cols] + [c for c in changed if c not in key_cols.split(", ")] + ["error_types"])
    views = BASKET_VIEWS if basket else (table,)
    prefix = ("WITH RECURSIVE " + CHAIN.strip() + ",\n") if basket else "WITH "
    body = prefix + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + f"\nSELECT {cols} FROM {last}"

    def fq(t, _c=cols):
        return faulted(t).select(*[c.strip() for c in _c.split(",")])
    fq.__doc__ = f"{tid.upper()}: {table} after its seeded fault plan (changed columns + labels)."
    query(f"{tid}_{table}_faults", views, body)(fq)
    return faulted


FAULTED = {table: _register_plan(table, spec) for table, spec in PLANS.items()}


def _register_detector(table: str):
    rules = DETECTORS[table]
    tid = PLANS[table]["id"]
    key_cols = {"store_catalogues": ["store_id", "product_id"], "product_content_quality": ["content_version_id"],
                "campaigns": ["campaign_id"], "campaign_exposures": ["event_id"], "bundle_pricings": ["bundle_pricing_id"],
                "promotions": ["promotion_id"], "product_reviews": ["review_id"]}[table]
    spec = PLANS[table]
    rk = spec.get("rk")
    base_sql = f"SELECT *{', ' + rk + ' AS __rk' if rk else ''} FROM {table}"
    ctes, last = E.plan_sql(f"{table}_b", spec["steps"], spec["key"], [])
    ctes = {f"{table}_b": base_sql, **ctes}
    lbl = labels_sql([(label, sql) for label, _, sql in rules])
    body = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + f"\nSELECT {', '.join(key_cols)}, {lbl} AS detected FROM {last}"

    def fn(t):
        return E.detect(FAULTED[table](t), [(label, sp) for label, sp, _ in rules]).select(*key_cols, "detected")
    fn.__doc__ = f"{tid.upper()} detector: labels found from the faulted {table} values alone."
    query(f"{tid}_{table}_detect", (table,), body)(fn)


for _t in DETECTORS:
    _register_detector(_t)


def _detect_sql(table: str, detect_sql: str, alias: str, src: str, keys: str, basket: bool = False) -> str:
    spec = PLANS[table]
    rk = spec.get("rk")
    src_sql = {"transactions": "hdr", "transaction_items": "items"}.get(table, table)
    base_sql = f"SELECT *{', ' + rk + ' AS __rk' if rk else ''} FROM {src_sql}"
    if table == "transactions":
        base_sql = f"SELECT * EXCLUDE (applied_promotions) FROM {src_sql}"
    ctes, last = E.plan_sql(f"{table}_b", spec["steps"], spec["key"], [])
    ctes = {f"{table}_b": base_sql, **ctes}
    det = (detect_sql.replace(f"SELECT {alias}.*,", f"SELECT {alias}.* EXCLUDE (error_types),")
           .replace(f"FROM {src} {alias}", f"FROM {last} {alias}"))
    ctes["det"] = det
    prefix = ("WITH RECURSIVE " + CHAIN.strip() + ",\n") if basket else "WITH "
    return prefix + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + f"\nSELECT {keys}, error_types AS detected FROM det"


from aislekit.plans.sql_detect import CUSTOMERS_E, ITEMS_E, PRODUCTS_E, TRANSACTIONS_E  # noqa: E402


@query("t01_customers_detect", ("customers",), _detect_sql("customers", CUSTOMERS_E, "c", "customers", "customer_id"))
def t01d(t):
    """T01 detector on the faulted customers (value rules + duplicate email)."""
    return Qd.detect_customers(FAULTED["customers"](t).drop(ERR)).select("customer_id", F.col(ERR).alias("detected"))


@query("t02_products_detect", ("products",), _detect_sql("products", PRODUCTS_E, "p", "products", "product_id"))
def t02d(t):
    """T02 detector on the faulted products."""
    return Qd.detect_products(FAULTED["products"](t).drop(ERR)).select("product_id", F.col(ERR).alias("detected"))


@query("t13_transactions_detect", BASKET_VIEWS, _detect_sql("transactions", TRANSACTIONS_E.replace(
    "list_filter([", "list_filter([CASE WHEN coalesce(abs(cart_subtotal - coalesce(total_discount, 0) + coalesce(shipping_fee, 0) - coalesce(shipping_discount, 0)"
    " - transaction_total) > 0.02, false) THEN 'calculation mismatch' END, CASE WHEN coalesce(cart_subtotal = 0, false) THEN 'zero cart subtotal for completed order' END, "
).replace("lambda x: x IS NOT NULL)", "lambda x: x IS NOT NULL)").replace(
    "CASE WHEN coalesce(transaction_time > TIMESTAMP '2025-01-01 00:00:00', false) THEN 'future transaction time' END",
    "CASE WHEN coalesce(transaction_time > TIMESTAMP '2025-01-01 00:00:00', false) THEN 'future transaction time' END, "
    "CASE WHEN coalesce(shipping_discount > shipping_fee, false) THEN 'shipping discount greater than shipping fee' END"),
    "t", "transactions", "transaction_id", basket=True))
def t13d(t):
    """T13 detector on the faulted priced transactions."""
    return Qd.detect_transactions(FAULTED["transactions"](t).drop(ERR)).select("transaction_id", F.col(ERR).alias("detected"))


@query("t14_transaction_items_detect", BASKET_VIEWS, _detect_sql("transaction_items", ITEMS_E.replace(
    "CASE WHEN coalesce(product_id IS NULL, false) THEN 'missing product ID' END",
    "CASE WHEN coalesce(item_discount > item_subtotal, false) THEN 'item discount greater than item subtotal' END, "
    "CASE WHEN coalesce(abs(final_item_price - (item_subtotal - item_discount)) > 0.02, false) THEN 'final item price mismatch' END, "
    "CASE WHEN coalesce(product_id IS NULL, false) THEN 'missing product ID' END"), "i", "transaction_items", "__rk", basket=True))
def t14d(t):
    """T14 detector on the faulted priced items (orphans against the headers)."""
    d = FAULTED["transaction_items"](t).drop(ERR)
    return Qd.detect_transaction_items(d, t.view("transactions")).select("__rk", F.col(ERR).alias("detected"))
