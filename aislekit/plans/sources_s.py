"""Sources, sinks and column decoders."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislekit.operators.profile import ERR, with_error_types
from aislekit.plans.basket_b import priced
from aislekit.plans.registry import query
from aislekit.plans.sql_basket import CHAIN, VIEWS as BASKET_VIEWS
from aislekit.sources import decode as S
from aislekit.sources import io

TX_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("store_id", T.LongType()), T.StructField("transaction_time", T.TimestampNTZType()),
    T.StructField("payment_method", T.StringType()), T.StructField("cart_subtotal", T.DecimalType(18, 2)),
    T.StructField("total_discount", T.DecimalType(18, 2)), T.StructField("shipping_fee", T.DecimalType(18, 2)),
    T.StructField("shipping_discount", T.DecimalType(18, 2)), T.StructField("transaction_total", T.DecimalType(18, 2)),
    T.StructField("basket_size", T.LongType()), T.StructField("num_unique_items", T.LongType()),
    T.StructField("applied_promotions", T.ArrayType(T.StructType([
        T.StructField("promotion_id", T.StringType()), T.StructField("promotion_type", T.StringType()),
        T.StructField("amount", T.DoubleType())]))),
])
PRICED = "WITH RECURSIVE " + CHAIN.strip() + "\n"


def _roundtrip(t):
    key = "__s07_roundtrip"
    if key not in t._frames:
        path = io.shared_path(t.spark, "s07")
        hdr = priced(t)["transactions"].select(*[f.name for f in TX_SCHEMA.fields])
        io.write_table(hdr, path)
        t._frames[key] = io.read_table(t.spark, path, TX_SCHEMA, decoders={"applied_promotions": S.parse_list_of_struct})
    return t._frames[key]


@query("s01_s07_csv_roundtrip", BASKET_VIEWS, PRICED + """
SELECT transaction_id, customer_id, store_id, transaction_time, payment_method, cart_subtotal, total_discount, shipping_fee,
  shipping_discount, transaction_total, basket_size, num_unique_items, applied_promotions FROM hdr""")
def s01(t):
    """Priced transactions written as CSV (arrays as JSON) and read back with the declared schema."""
    return _roundtrip(t)


@query("s02_parse_list", ("transaction_items",), """
SELECT transaction_id, list_sort(list(CAST(product_id AS VARCHAR))) AS products FROM transaction_items GROUP BY 1""")
def s02(t):
    """List text (JSON for even ids, Python-literal for odd) parsed to arrays."""
    it = t.view("transaction_items")
    q = F.when(F.col("transaction_id") % 2 == 0, F.lit('"')).otherwise(F.lit("'"))
    txt = it.groupBy("transaction_id").agg(F.concat(F.lit("["), F.concat_ws(", ", F.sort_array(F.collect_list(
        F.concat(q, F.col("product_id").cast("string"), q)))), F.lit("]")).alias("txt"))
    return txt.select("transaction_id", F.sort_array(S.parse_list(F.col("txt"))).alias("products"))


@query("s03_parse_list_of_struct", BASKET_VIEWS, PRICED + "SELECT transaction_id, applied_promotions FROM hdr")
def s03(t):
    """Applied promotions as JSON text (single quotes on odd ids) parsed back to structs."""
    h = priced(t)["transactions"]
    txt = F.to_json("applied_promotions")
    txt = F.when(F.col("transaction_id") % 2 == 1, F.translate(txt, '"', "'")).otherwise(txt)
    return h.select("transaction_id", S.parse_list_of_struct(txt).alias("applied_promotions"))


@query("s04_parse_channels", ("campaigns",), """
SELECT campaign_id, CASE WHEN campaign_id % 2 = 0 THEN list_filter(list_transform(string_split(trim(channels), ','), lambda x: trim(x)), lambda x: x <> '')
  ELSE list_filter(list_transform(string_split(trim(channels), ','), lambda x: trim(x)), lambda x: x <> '') END AS channel_list FROM campaigns""")
def s04(t):
    """Channel text parsed (comma text for even ids, a literal list for odd ids)."""
    c = t.view("campaigns")
    lit = F.concat(F.lit("['"), F.regexp_replace(F.col("channels"), ",", "', '"), F.lit("']"))
    txt = F.when(F.col("campaign_id") % 2 == 0, F.col("channels")).otherwise(lit)
    return c.select("campaign_id", S.parse_channels(txt).alias("channel_list"))


@query("s05_normalise_bool", ("customers",), """
SELECT customer_id, CASE WHEN customer_id % 5 = 4 THEN NULL ELSE email_marketing_opt_in END AS email_opt_in FROM customers""")
def s05(t):
    """Opt-in flags written as mixed-case text (and junk) normalised to booleans."""
    c = t.view("customers")
    raw = (F.when(F.col("customer_id") % 5 == 0, F.upper(F.col("email_marketing_opt_in").cast("string")))
           .when(F.col("customer_id") % 5 == 1, F.initcap(F.col("email_marketing_opt_in").cast("string")))
           .when(F.col("customer_id") % 5 == 4, F.lit("yes"))
           .otherwise(F.concat(F.lit(" "), F.col("email_marketing_opt_in").cast("string"))))
    return c.select("customer_id", S.normalise_bool(raw).alias("email_opt_in"))


@query("s06_parse_error_types", ("customers",), """
SELECT customer_id, CASE WHEN customer_id % 2 = 0 AND loyalty_points < 0 THEN ['negative loyalty points'] ELSE CAST([] AS VARCHAR[]) END AS error_types
FROM customers""")
def s06(t):
    """error_types read from text for even ids (junk text gives []); odd ids
    come from a table without the column, which gets []."""
    c = t.view("customers")
    txt = F.when(F.col("loyalty_points") < 0, F.lit("['negative loyalty points']")).when(F.col("customer_id") % 3 == 0, F.lit("not a list"))
    with_col = c.where(F.col("customer_id") % 2 == 0).select("customer_id", S.parse_list(txt).alias(ERR))
    without = with_error_types(c.where(F.col("customer_id") % 2 == 1).select("customer_id"))
    return with_col.unionByName(without)


def _summary_sql():
    from aislekit.plans.profile_q import _PROFILE_TABLES, _profile_sql
    from aislekit.sources.adapters import with_views

    body = "\nUNION ALL\n".join(_profile_sql(n, c, cols) for n, c, cols, _, _ in _PROFILE_TABLES)
    return body, {c: sql for _, c, _, sql, _ in _PROFILE_TABLES}


@query("s08_write_summary", ("customers", "products", "transactions", "transaction_items"), _summary_sql()[0], _summary_sql()[1])
def s08(t):
    """Profile summary written as one CSV and read back (rows by dirty ratio)."""
    from aislekit.plans.profile_q import summary

    path = io.shared_path(t.spark, "s08")
    io.write_summary(summary(t), path)
    schema = T.StructType([T.StructField("dataset", T.StringType()), T.StructField("total_rows", T.LongType()),
                           T.StructField("dirty_rows", T.LongType()), T.StructField("dirty_ratio", T.DoubleType()),
                           T.StructField("health_score", T.DoubleType()), T.StructField("total_error_types", T.LongType()),
                           T.StructField("total_errors", T.LongType()), T.StructField("top_error", T.StringType()),
                           T.StructField("numeric_columns", T.LongType())])
    return io.read_table(t.spark, path, schema)
