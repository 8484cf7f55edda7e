"""Schema contracts on the driver-derived tables."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislekit.operators import contracts as V
from aislekit.plans.registry import query
from aislekit.sources.decode import parse_channels
from aislekit.sources.schemas import CONTRACTS


def _as_text(df: DataFrame) -> DataFrame:
    """A table as it arrives from CSV: every column text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query("v01_type_check", ("clickstreams",), """
SELECT * FROM (VALUES
 ('event_id', 'int', (SELECT count(event_id) FROM clickstreams), 0),
 ('session_id', 'string', (SELECT count(session_id) FROM clickstreams), 0),
 ('customer_id', 'int', (SELECT count(customer_id) FROM clickstreams), 0),
 ('event_type', 'string', (SELECT count(event_type) FROM clickstreams), 0),
 ('product_id', 'int', (SELECT count(product_id) FROM clickstreams), 0),
 ('scroll_depth', 'int', (SELECT count(scroll_depth) FROM clickstreams),
   (SELECT count(*) FROM clickstreams WHERE scroll_depth IS NOT NULL AND scroll_depth <> floor(scroll_depth))))
 v(column_name, declared, checked, failed)""")
def v01(t):
    """Declared types checked value by value on the click table read as text."""
    return V.type_failures(_as_text(t.view("clickstreams")), CONTRACTS["clickstreams"]["types"]) \
        .select("column_name", "declared", F.col("checked").cast("long"), F.col("failed").cast("long"))


@query("v02_date_parse", ("promotions",), """
SELECT * FROM (VALUES ('effective_start_date', (SELECT count(*) FROM promotions WHERE effective_start_date IS NOT NULL), 0),
  ('effective_end_date', (SELECT count(*) FROM promotions WHERE effective_end_date IS NOT NULL), 0)) v(column_name, checked, failed)""")
def v02(t):
    """Date columns of promotions (as text) parse as dates."""
    return V.parse_failures(_as_text(t.view("promotions")), CONTRACTS["promotions"]["date_columns"], "date")


@query("v03_timestamp_parse", ("clickstreams",), """
SELECT 'event_timestamp' AS column_name, count(event_timestamp) AS checked, 0 AS failed FROM clickstreams""")
def v03(t):
    """Timestamp columns of the click table (as text) parse as timestamps."""
    return V.parse_failures(_as_text(t.view("clickstreams")), CONTRACTS["clickstreams"]["datetime_columns"], "timestamp")


@query("v04_pk_unique", (), """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def v04(t):
    """Order-line keys (order, line number) held by more than one line."""
    return V.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("v05_unique_column", ("customers",), """
SELECT email, count(*) AS n FROM customers WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def v05(t):
    """Customer emails used by more than one customer (nulls ignored)."""
    return V.duplicate_keys(t.view("customers"), ["email"], ignore_nulls=True)


@query("v06_unique_combination", ("transactions",), """
SELECT customer_id, store_id, transaction_time, count(*) AS n FROM transactions GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def v06(t):
    """(customer, store, time) combinations held by more than one transaction."""
    return V.duplicate_keys(t.view("transactions"), ["customer_id", "store_id", "transaction_time"])


@query("v07_list_bridge_unique", ("campaigns",), """
SELECT campaign_id, channel, count(*) AS n FROM (
  SELECT campaign_id, trim(replace(trim(unnest(string_split(channels || ',' || channels, ','))), '"', '')) AS channel FROM campaigns)
WHERE channel <> '' GROUP BY 1, 2 HAVING count(*) > 1""")
def v07(t):
    """(campaign, channel) pairs repeated inside the channel lists (the list
    here is the campaign's channels written twice, so every pair repeats)."""
    c = t.view("campaigns").select("campaign_id", parse_channels(F.concat_ws(",", "channels", "channels")).alias("ch"))
    return V.list_bridge_duplicates(c, "campaign_id", "ch", "channel")


@query("v08_foreign_keys", ("clickstreams", "customers", "products", "transaction_items", "transactions"), """
SELECT 'clickstreams.customer_id' AS rule, CAST(event_id AS BIGINT) AS row_key FROM clickstreams c
  WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM customers WHERE customer_id IS NOT NULL)
UNION ALL
SELECT 'clickstreams.product_id', CAST(event_id AS BIGINT) FROM clickstreams
  WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM products WHERE product_id IS NOT NULL)
UNION ALL
SELECT 'transaction_items.transaction_id', CAST(transaction_id AS BIGINT) FROM transaction_items
  WHERE transaction_id IS NOT NULL AND transaction_id NOT IN (SELECT transaction_id FROM transactions WHERE transaction_id IS NOT NULL)""")
def v08(t):
    """Rows whose foreign key is missing from the parent table."""
    cs = t.view("clickstreams")
    a = V.orphan_keys(cs, "customer_id", t.view("customers"), "customer_id").select(
        F.lit("clickstreams.customer_id").alias("rule"), F.col("event_id").cast("long").alias("row_key"))
    b = V.orphan_keys(cs, "product_id", t.view("products"), "product_id").select(
        F.lit("clickstreams.product_id").alias("rule"), F.col("event_id").cast("long").alias("row_key"))
    c = V.orphan_keys(t.view("transaction_items"), "transaction_id", t.view("transactions"), "transaction_id").select(
        F.lit("transaction_items.transaction_id").alias("rule"), F.col("transaction_id").cast("long").alias("row_key"))
    return a.unionByName(b).unionByName(c)


@query("v09_list_foreign_keys", ("bundle_items", "products"), """
SELECT bundle_id, element FROM (SELECT bundle_id, CAST(product_id + 7 AS VARCHAR(20)) AS element FROM bundle_items)
WHERE element NOT IN (SELECT CAST(product_id AS VARCHAR(20)) FROM products)""")
def v09(t):
    """Bundle member lists (member id shifted by 7) checked against products."""
    lists = (t.view("bundle_items").groupBy("bundle_id")
             .agg(F.collect_list((F.col("product_id") + 7).cast("string")).alias("members")))
    return V.orphan_list_elements(lists, "bundle_id", "members", t.view("products"), "product_id")


@query("v11_accepted_values", ("transactions",), """
SELECT transaction_id, payment_method FROM transactions
WHERE payment_method IS NOT NULL AND payment_method NOT IN ('Credit Card', 'Debit Card', 'Digital Wallet', 'Buy Now Pay Later', 'Cash')""")
def v11(t):
    """Transactions with a payment method outside the accepted list."""
    allowed = CONTRACTS["transactions"]["accepted_values"]["payment_method"]
    return t.view("transactions").where(V.value_not_accepted(F.col("payment_method"), allowed)) \
        .select("transaction_id", "payment_method")


@query("v12_regex", ("customers",), """
SELECT customer_id, email FROM customers
WHERE email IS NOT NULL AND email <> '' AND NOT regexp_full_match(email, '^[^@]+@[^@]+\\.[^@]+$')""")
def v12(t):
    """Customer emails that do not fully match the email pattern."""
    pat = CONTRACTS["customers"]["regex"]["email"]
    return t.view("customers").where(V.regex_mismatch(F.col("email"), pat)).select("customer_id", "email")


@query("v15_ranges", ("customers", "transaction_items"), """
SELECT 'customers.loyalty_points' AS rule, CAST(customer_id AS BIGINT) AS row_key FROM customers WHERE loyalty_points < 0
UNION ALL SELECT 'transaction_items.quantity', CAST(transaction_id AS BIGINT) FROM transaction_items WHERE quantity < 1""")
def v15(t):
    """Rows outside declared numeric ranges (open ends)."""
    a = t.view("customers").where(V.out_of_range(F.col("loyalty_points"), 0, None)).select(
        F.lit("customers.loyalty_points").alias("rule"), F.col("customer_id").cast("long").alias("row_key"))
    b = t.view("transaction_items").where(V.out_of_range(F.col("quantity"), 1, None)).select(
        F.lit("transaction_items.quantity").alias("rule"), F.col("transaction_id").cast("long").alias("row_key"))
    return a.unionByName(b)


@query("v16_contract_runner", ("transactions", "customers", "stores"), """
WITH n AS (SELECT count(*) AS c FROM transactions)
SELECT 'transactions' AS table_name, rule, column_name, CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed FROM (
 SELECT 'not_null' AS rule, 'transaction_id' AS column_name, count(*) AS checked, count(*) FILTER (WHERE transaction_id IS NULL) AS failed FROM transactions
 UNION ALL SELECT 'not_null', 'customer_id', count(*), count(*) FILTER (WHERE customer_id IS NULL) FROM transactions
 UNION ALL SELECT 'not_null', 'store_id', count(*), count(*) FILTER (WHERE store_id IS NULL) FROM transactions
 UNION ALL SELECT 'not_null', 'transaction_time', count(*), count(*) FILTER (WHERE transaction_time IS NULL) FROM transactions
 UNION ALL SELECT 'not_null', 'transaction_total', count(*), count(*) FILTER (WHERE transaction_total IS NULL) FROM transactions
 UNION ALL SELECT 'not_null', 'payment_method', count(*), count(*) FILTER (WHERE payment_method IS NULL) FROM transactions
 UNION ALL SELECT 'accepted_values', 'payment_method', count(payment_method),
   count(*) FILTER (WHERE payment_method NOT IN ('Credit Card', 'Debit Card', 'Digital Wallet', 'Buy Now Pay Later', 'Cash')) FROM transactions
 UNION ALL SELECT 'range', 'transaction_total', count(transaction_total), count(*) FILTER (WHERE transaction_total < 0) FROM transactions
 UNION ALL SELECT 'type', 'transaction_id', count(transaction_id), 0 FROM transactions
 UNION ALL SELECT 'type', 'customer_id', count(customer_id), 0 FROM transactions
 UNION ALL SELECT 'type', 'store_id', count(store_id), 0 FROM transactions
 UNION ALL SELECT 'type', 'transaction_total', count(transaction_total), 0 FROM transactions
 UNION ALL SELECT 'type', 'payment_method', count(payment_method), 0 FROM transactions
 UNION ALL SELECT 'pk_unique', 'transaction_id', (SELECT c FROM n), coalesce((SELECT sum(k) FROM (SELECT count(*) AS k FROM transactions GROUP BY transaction_id HAVING count(*) > 1)), 0)
 UNION ALL SELECT 'unique_combination', 'customer_id,store_id,transaction_time', (SELECT c FROM n),
   coalesce((SELECT sum(k) FROM (SELECT count(*) AS k FROM transactions GROUP BY customer_id, store_id, transaction_time HAVING count(*) > 1)), 0)
 UNION ALL SELECT 'fk', 'customer_id', (SELECT c FROM n), (SELECT count(*) FROM transactions WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM customers WHERE customer_id IS NOT NULL))
 UNION ALL SELECT 'fk', 'store_id', (SELECT c FROM n), (SELECT count(*) FROM transactions WHERE store_id IS NOT NULL AND store_id NOT IN (SELECT store_id FROM stores WHERE store_id IS NOT NULL))
)""")
def v16(t):
    """Every contract rule of transactions with checked / failed counts."""
    return V.run_contract("transactions", t.view("transactions"), CONTRACTS["transactions"],
                          {"customers": t.view("customers"), "stores": t.view("stores")})
