"""Fault plans (T01-T15) as step lists, with value-based detectors.

Rates and labels are the source's; random values are functions of the
step's draw ``u``.  Each step carries its Spark expression and the oracle
SQL text of the same value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators.faults import Step

NOW_DATE = "2025-01-01"
DIGITAL_SQL = "customer_type IN ('Online Only', 'Omnichannel')"


def digital():
    return F.col("customer_type").isin("Online Only", "Omnichannel")


def future_date(u):
    return F.date_add(F.lit(NOW_DATE).cast("date"), (1 + F.floor(u * 3650)).cast("int"))


FUTURE_DATE_SQL = f"CAST(DATE '{NOW_DATE}' + CAST(1 + floor({{u}} * 3650) AS INTEGER) AS DATE)"
FUTURE_TS_SQL = f"CAST(DATE '{NOW_DATE}' + CAST(1 + floor({{u}} * 3650) AS INTEGER) AS TIMESTAMP)"


def money(c):
    return F.round(c.cast("decimal(38,6)"), 2).cast("decimal(18,2)")


def money_sql(e: str) -> str:
    return f"CAST(round(CAST({e} AS DECIMAL(38,6)), 2) AS DECIMAL(18,2))"


PLANS: dict[str, dict] = {
    "customers": {"id": "t01", "key": "customer_id", "steps": [
        Step("null", "email", 0.06, "missing email", mask=digital, sql_mask=DIGITAL_SQL),
        Step("null", "region", 0.06, "missing region", mask=digital, sql_mask=DIGITAL_SQL),
        Step("null", "area", 0.06, "missing area", mask=digital, sql_mask=DIGITAL_SQL),
        Step("set", "email", 0.03, "duplicate email",
             value=lambda u: F.concat(F.lit("c"), (F.col("customer_id") + 1).cast("string"), F.lit("@example.org")),
             mask=lambda: digital() & F.col("email").isNotNull(),
             sql_value="'c' || CAST(customer_id + 1 AS VARCHAR) || '@example.org'", sql_mask=f"{DIGITAL_SQL} AND email IS NOT NULL"),
        Step("ws", "email", 0.08, "email formatting anomaly"),
        Step("set", "signup_date", 0.02, "future signup date", value=future_date, sql_value=FUTURE_DATE_SQL),
        Step("set", "dob", 0.03, "invalid date of birth",
             value=lambda u: F.when(u < 0.5, future_date(u)).otherwise(F.date_add(F.lit("1850-01-01").cast("date"), F.floor(u * 3650).cast("int"))),
             mask=lambda: F.col("dob").isNotNull(),
             sql_value="CASE WHEN {u} < 0.5 THEN CAST(DATE '2025-01-01' + CAST(1 + floor({u} * 3650) AS INTEGER) AS DATE) "
                       "ELSE CAST(DATE '1850-01-01' + CAST(floor({u} * 3650) AS INTEGER) AS DATE) END", sql_mask="dob IS NOT NULL"),
        Step("set", "dob", 0.02, "underage date of birth",
             value=lambda u: F.date_sub(F.lit(NOW_DATE).cast("date"), (1825 + F.floor(u * 2555)).cast("int")),
             mask=lambda: F.col("dob").isNotNull(),
             sql_value="CAST(DATE '2025-01-01' - CAST(1825 + floor({u} * 2555) AS INTEGER) AS DATE)", sql_mask="dob IS NOT NULL"),
        Step("set", "loyalty_points", 0.02, "negative loyalty points", value=lambda u: -(1 + F.floor(u * 500)).cast("long"),
             mask=lambda: F.col("loyalty_points").isNotNull(),
             sql_value="-CAST(1 + floor({u} * 500) AS BIGINT)", sql_mask="loyalty_points IS NOT NULL"),
        Step("null", "customer_segment", 0.04, "missing customer segment", mask=digital, sql_mask=DIGITAL_SQL),
    ]},
    "products": {"id": "t02", "key": "product_id", "steps": [
        Step("set", "selling_price", 0.02, "zero or negative selling price",
             value=lambda u: F.when(u < 0.5, F.lit(0).cast("decimal(18,2)")).otherwise(money(-(1 + u * 49))),
             sql_value=f"CASE WHEN {{u}} < 0.5 THEN CAST(0 AS DECIMAL(18,2)) ELSE {money_sql('-(1 + {u} * 49)')} END"),
        Step("set", "cost_price", 0.03, "margin inversion", value=lambda u: money(F.col("selling_price") * (1.1 + u * 0.4)),
             sql_value=money_sql("selling_price * (1.1 + {u} * 0.4)")),
        Step("set", "selling_price", 0.01, "extreme outlier price", value=lambda u: money(10000 + u * 990000),
             sql_value=money_sql("10000 + {u} * 990000")),
        Step("null", "brand", 0.03, "missing brand", mask=lambda: F.col("brand").isNotNull(), sql_mask="brand IS NOT NULL"),
        Step("ws", "product_name", 0.06, "product name formatting anomaly"),
    ]},
    "store_catalogues": {"id": "t04", "key": "__rk", "rk": "store_id * 100000000000 + product_id",
                         "rk_spark": lambda: F.col("store_id") * 100000000000 + F.col("product_id"), "steps": [
        Step("set", "store_selling_price", 0.05, "price anomaly", value=lambda u: money(F.col("store_selling_price") * (1.4 + u * 1.1)),
             sql_value=money_sql("store_selling_price * (1.4 + {u} * 1.1)")),
        Step("set", "store_category", 0.06, "category label drift",
             value=lambda u: F.element_at(F.array(*[F.lit(c) for c in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]]),
                                          (F.floor(u * 6) + 1).cast("int")),
             sql_value="['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'][CAST(floor({u} * 6) + 1 AS INTEGER)]"),
        Step("null", "store_selling_price", 0.02, "missing store selling price",
             mask=lambda: ~F.array_contains("error_types", "price anomaly"), sql_mask="NOT list_contains(error_types, 'price anomaly')"),
        Step("ws", "store_product_name", 0.07, "store product name formatting anomaly"),
        Step("dup", None, 0.03, "duplicate listing"),
    ]},
    "product_content_quality": {"id": "t05", "key": "content_version_id", "steps": [
        Step("set", "image_count", 0.03, "has_image=False but image_count > 0", value=lambda u: (1 + F.floor(u * 5)).cast("long"),
             mask=lambda: ~F.col("has_image"), sql_value="CAST(1 + floor({u} * 5) AS BIGINT)", sql_mask="NOT has_image"),
        Step("set", "image_quality_score", 0.02, "image_quality_score > 1.0", value=lambda u: money(1.01 + u * 0.99),
             sql_value=money_sql("1.01 + {u} * 0.99")),
        Step("set", "description_length", 0.02, "negative description length", value=lambda u: -(1 + F.floor(u * 100)).cast("long"),
             sql_value="-CAST(1 + floor({u} * 100) AS BIGINT)"),
    ]},
    "campaigns": {"id": "t07", "key": "campaign_id", "steps": [
        Step("swap", "start_date", 0.02, "inverted date range", extra={"with": "end_date"}),
        Step("null", "target_segment", 0.03, "missing target segment", mask=lambda: F.col("target_segment").isNotNull(),
             sql_mask="target_segment IS NOT NULL"),
    ]},
    "campaign_exposures": {"id": "t08", "key": "event_id", "steps": [
        Step("flag", None, 0.0, "exposed=False but exposed_time populated", mask=lambda: ~F.col("exposed") & F.col("exposed_time").isNotNull(),
             sql_mask="NOT exposed AND exposed_time IS NOT NULL"),
        Step("swap", "clicked_time", 0.02, "clicked time before opened time", extra={"with": "opened_time"},
             mask=lambda: F.col("clicked_time").isNotNull() & F.col("opened_time").isNotNull(),
             sql_mask="clicked_time IS NOT NULL AND opened_time IS NOT NULL"),
        Step("set", "opened_time", 0.02, "opened time before exposed time",
             value=lambda u: F.col("exposed_time") - F.make_interval(mins=(1 + F.floor(u * 60)).cast("int")),
             mask=lambda: F.col("opened_time").isNotNull() & F.col("exposed_time").isNotNull(),
             sql_value="exposed_time - to_minutes(CAST(1 + floor({u} * 60) AS BIGINT))",
             sql_mask="opened_time IS NOT NULL AND exposed_time IS NOT NULL"),
        Step("set", "cost_per_msg", 0.01, "negative cost per message", value=lambda u: -F.abs(F.col("cost_per_msg")),
             mask=lambda: F.col("cost_per_msg").isNotNull(), sql_value="-abs(cost_per_msg)", sql_mask="cost_per_msg IS NOT NULL"),
        Step("null", "channel", 0.02, "missing channel", mask=lambda: F.col("channel").isNotNull(), sql_mask="channel IS NOT NULL"),
        Step("dup", None, 0.03, "duplicate row"),
    ]},
    "bundle_pricings": {"id": "t10", "key": "bundle_pricing_id", "steps": [
        Step("set", "discount_value", 0.03, "negative discount value", value=lambda u: -F.abs(F.col("discount_value")),
             mask=lambda: F.col("discount_value").isNotNull(), sql_value="-abs(discount_value)", sql_mask="discount_value IS NOT NULL"),
        Step("null", "discount_value", 0.02, "missing discount value", mask=lambda: F.col("discount_value").isNotNull(),
             sql_mask="discount_value IS NOT NULL"),
        Step("swap", "effective_start_date", 0.02, "inverted date range", extra={"with": "effective_end_date"}),
        Step("dup", None, 0.03, "duplicate row"),
    ]},
    "promotions": {"id": "t11", "key": "promotion_id", "steps": [
        Step("set", "promotion_value", 0.03, "zero promotion value for non-free-shipping", value=lambda u: F.lit(0).cast("decimal(18,2)"),
             mask=lambda: F.col("promotion_mechanic") != "free_shipping", sql_value="CAST(0 AS DECIMAL(18,2))",
             sql_mask="promotion_mechanic <> 'free_shipping'"),
        Step("swap", "effective_start_date", 0.02, "inverted date range", extra={"with": "effective_end_date"}),
        Step("null", "promotion_value", 0.02, "missing promotion value", mask=lambda: F.col("promotion_value").isNotNull(),
             sql_mask="promotion_value IS NOT NULL"),
        Step("set", "promotion_scope", 0.02, "free shipping promotion with product scope", value=lambda u: F.lit("product"),
             mask=lambda: F.col("promotion_mechanic") == "free_shipping", sql_value="'product'", sql_mask="promotion_mechanic = 'free_shipping'"),
        Step("set", "min_spend", 0.01, "negative min spend", value=lambda u: -F.abs(F.col("min_spend")),
             mask=lambda: F.col("min_spend").isNotNull(), sql_value="-abs(min_spend)", sql_mask="min_spend IS NOT NULL"),
    ]},
    "transactions": {"id": "t13", "key": "transaction_id", "steps": [
        Step("set", "transaction_total", 0.05, "calculation error", value=lambda u: money(F.col("transaction_total") + (u * 100 - 50)),
             sql_value=money_sql("transaction_total + ({u} * 100 - 50)")),
        Step("set", "transaction_total", 0.02, "negative transaction total", value=lambda u: -F.abs(F.col("transaction_total")),
             sql_value="-abs(transaction_total)"),
        Step("null", "customer_id", 0.03, "missing customer ID", mask=lambda: F.col("customer_id").isNotNull(), sql_mask="customer_id IS NOT NULL"),
        Step("set", "payment_method", 0.02, "invalid payment method",
             value=lambda u: F.element_at(F.array(*[F.lit(x) for x in ["Bitcoin", "Barter", "Gift Card", "UNKNOWN"]]), (F.floor(u * 4) + 1).cast("int")),
             mask=lambda: F.col("payment_method").isNotNull(),
             sql_value="['Bitcoin', 'Barter', 'Gift Card', 'UNKNOWN'][CAST(floor({u} * 4) + 1 AS INTEGER)]", sql_mask="payment_method IS NOT NULL"),
        Step("set", "transaction_time", 0.01, "future transaction time", value=lambda u: future_date(u).cast("timestamp_ntz"),
             mask=lambda: F.col("transaction_time").isNotNull(), sql_value=FUTURE_TS_SQL, sql_mask="transaction_time IS NOT NULL"),
        Step("dup", None, 0.02, "duplicate transaction id"),
    ]},
    "transaction_items": {"id": "t14", "key": "__rk", "rk": "transaction_id * 100003 + product_id",
                          "rk_spark": lambda: F.col("transaction_id") * 100003 + F.col("product_id"), "steps": [
        Step("set", "transaction_id", 0.02, "orphaned transaction item", value=lambda u: (1000000000 + F.floor(u * 9000)).cast("long"),
             sql_value="CAST(1000000000 + floor({u} * 9000) AS BIGINT)"),
        Step("set", "unit_price", 0.02, "zero unit price", value=lambda u: F.lit(0).cast("decimal(18,2)"), sql_value="CAST(0 AS DECIMAL(18,2))"),
        Step("set", "quantity", 0.02, "invalid quantity", value=lambda u: F.when(u < 0.5, F.lit(0)).otherwise(-(1 + F.floor(u * 5))).cast("long"),
             sql_value="CAST(CASE WHEN {u} < 0.5 THEN 0 ELSE -(1 + floor({u} * 5)) END AS BIGINT)"),
        Step("null", "product_id", 0.02, "missing product ID", mask=lambda: F.col("product_id").isNotNull(), sql_mask="product_id IS NOT NULL"),
    ]},
    "product_reviews": {"id": "t15", "key": "review_id", "steps": [
        Step("set", "rating", 0.03, "rating out of range",
             value=lambda u: F.when(u < 0.5, -F.floor(u * 10)).otherwise(6 + F.floor(u * 5)).cast("long"),
             sql_value="CAST(CASE WHEN {u} < 0.5 THEN -floor({u} * 10) ELSE 6 + floor({u} * 5) END AS BIGINT)"),
        Step("set", "review_date", 0.02, "future review date", value=future_date, sql_value=FUTURE_DATE_SQL),
        Step("null", "review_text", 0.04, "missing review text", mask=lambda: F.col("review_text").isNotNull(), sql_mask="review_text IS NOT NULL"),
        Step("dup", None, 0.04, "duplicate row"),
        Step("ws", "review_text", 0.05, "review text formatting anomaly"),
    ]},
}

DETECTORS: dict[str, list[tuple[str, object, str]]] = {
    "store_catalogues": [
        ("missing store selling price", lambda: F.col("store_selling_price").isNull(), "store_selling_price IS NULL"),
        ("store product name formatting anomaly", lambda: F.col("store_product_name") != F.trim(F.lower(F.col("store_product_name"))),
         "store_product_name <> trim(lower(store_product_name))"),
    ],
    "product_content_quality": [
        ("has_image=False but image_count > 0", lambda: ~F.col("has_image") & (F.col("image_count") > 0), "NOT has_image AND image_count > 0"),
        ("image_quality_score > 1.0", lambda: F.col("image_quality_score") > 1.0, "image_quality_score > 1.0"),
        ("negative description length", lambda: F.col("description_length") < 0, "description_length < 0"),
    ],
    "campaigns": [
        ("inverted date range", lambda: F.col("start_date") > F.col("end_date"), "start_date > end_date"),
        ("missing target segment", lambda: F.col("target_segment").isNull(), "target_segment IS NULL"),
    ],
    "campaign_exposures": [
        ("exposed=False but exposed_time populated", lambda: ~F.col("exposed") & F.col("exposed_time").isNotNull(),
         "NOT exposed AND exposed_time IS NOT NULL"),
        ("clicked time before opened time", lambda: F.col("clicked_time") < F.col("opened_time"), "clicked_time < opened_time"),
        ("opened time before exposed time", lambda: F.col("opened_time") < F.col("exposed_time"), "opened_time < exposed_time"),
        ("negative cost per message", lambda: F.col("cost_per_msg") < 0, "cost_per_msg < 0"),
        ("missing channel", lambda: F.col("channel").isNull(), "channel IS NULL"),
    ],
    "bundle_pricings": [
        ("negative discount value", lambda: F.col("discount_value") < 0, "discount_value < 0"),
        ("missing discount value", lambda: F.col("discount_value").isNull(), "discount_value IS NULL"),
        ("inverted date range", lambda: F.col("effective_start_date") > F.col("effective_end_date"), "effective_start_date > effective_end_date"),
    ],
    "promotions": [
        ("zero promotion value for non-free-shipping", lambda: (F.col("promotion_value") == 0) & (F.col("promotion_mechanic") != "free_shipping"),
         "promotion_value = 0 AND promotion_mechanic <> 'free_shipping'"),
        ("inverted date range", lambda: F.col("effective_start_date") > F.col("effective_end_date"), "effective_start_date > effective_end_date"),
        ("missing promotion value", lambda: F.col("promotion_value").isNull(), "promotion_value IS NULL"),
        ("free shipping promotion with product scope", lambda: (F.col("promotion_mechanic") == "free_shipping") & (F.col("promotion_scope") == "product"),
         "promotion_mechanic = 'free_shipping' AND promotion_scope = 'product'"),
        ("negative min spend", lambda: F.col("min_spend") < 0, "min_spend < 0"),
    ],
    "product_reviews": [
        ("rating out of range", lambda: ~F.col("rating").between(1, 5), "NOT (rating BETWEEN 1 AND 5)"),
        ("future review date", lambda: F.col("review_date") > F.lit(NOW_DATE).cast("date"), "review_date > DATE '2025-01-01'"),
        ("missing review text", lambda: F.col("review_text").isNull(), "review_text IS NULL"),
    ],
}
