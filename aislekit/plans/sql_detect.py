"""Oracle-side SQL for detected tables (DuckDB dialect), shared by plans."""

NOW_SQL = "TIMESTAMP '2025-01-01 00:00:00'"


def labels_sql(rules: list[tuple[str, str]]) -> str:
    items = ", ".join(f"CASE WHEN coalesce({p}, false) THEN '{lbl}' END" for lbl, p in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


CUSTOMERS_E = f"""
SELECT c.*, {labels_sql([
    ("missing email", "customer_type IN ('Online Only','Omnichannel') AND email IS NULL"),
    ("missing region", "customer_type IN ('Online Only','Omnichannel') AND region IS NULL"),
    ("missing area", "customer_type IN ('Online Only','Omnichannel') AND area IS NULL"),
    ("duplicate email", "email IS NOT NULL AND count(*) OVER (PARTITION BY email) > 1"),
    ("email formatting anomaly", "email <> lower(trim(email))"),
    ("future signup date", f"signup_date > {NOW_SQL}"),
    ("invalid date of birth", f"dob > {NOW_SQL} OR dob < DATE '1900-01-01'"),
    ("underage date of birth", "dob > signup_date - INTERVAL 216 MONTH"),
    ("negative loyalty points", "loyalty_points < 0"),
    ("missing customer segment", "customer_type IN ('Online Only','Omnichannel') AND customer_segment IS NULL"),
])} AS error_types
FROM customers c
"""

PRODUCTS_E = f"""
SELECT p.*, {labels_sql([
    ("zero or negative selling price", "selling_price <= 0"),
    ("margin inversion", "cost_price > selling_price"),
    ("extreme outlier price", "selling_price >= 10000"),
    ("missing brand", "brand IS NULL"),
    ("product name formatting anomaly", "product_name <> trim(product_name) OR (product_name = upper(product_name) AND product_name <> lower(product_name))"),
    ("duplicate product name", "product_name IS NOT NULL AND count(*) OVER (PARTITION BY product_name) > 1"),
])} AS error_types
FROM products p
"""

TRANSACTIONS_E = f"""
SELECT t.*, {labels_sql([
    ("negative transaction total", "transaction_total < 0"),
    ("missing customer ID", "customer_id IS NULL"),
    ("duplicate transaction id", "transaction_id IS NOT NULL AND count(*) OVER (PARTITION BY transaction_id) > 1"),
    ("invalid payment method", "payment_method NOT IN ('Credit Card','Debit Card','Digital Wallet','Buy Now Pay Later','Cash')"),
    ("future transaction time", f"transaction_time > {NOW_SQL}"),
])} AS error_types
FROM transactions t
"""

ITEMS_E = f"""
SELECT i.*, {labels_sql([
    ("orphaned transaction item", "i.transaction_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM transactions t WHERE t.transaction_id = i.transaction_id)"),
    ("zero unit price", "unit_price = 0"),
    ("invalid quantity", "quantity <= 0"),
    ("missing product ID", "product_id IS NULL"),
])} AS error_types
FROM transaction_items i
"""
