"""Value-based detectors: the same labels the fault plans inject (T01-T15),
found from the values alone.

A detector is a list of ``(label, predicate)``; the labels of every true
predicate are added to ``error_types`` in one projection
(``array_compact(array(when(p, label), ...))``), so all rules of a table
share one scan.  Rules that need other rows (duplicates, orphans) are
computed with a grouped count or a key lookup joined back on the key: the
count is partially aggregated before the shuffle, so a hot key costs one
row per partition, not one task holding all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislekit.operators.profile import ERR, with_error_types

# The default "now" used by every time check (a parameter,
# never the wall clock, so results repeat).
DEFAULT_NOW = "2025-01-01 00:00:00"

# Accepted payment methods of the transactions contract.
PAYMENT_METHODS = ["Credit Card", "Debit Card", "Digital Wallet", "Buy Now Pay Later", "Cash"]
DIGITAL_TYPES = ["Online Only", "Omnichannel"]


def add_labels(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Append each label whose predicate is true (null counts as false)."""
    d = with_error_types(df)
    found = F.array_compact(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(lbl)) for lbl, p in rules]))
    return d.withColumn(ERR, F.array_distinct(F.concat(F.col(ERR), found)))


def flag_repeated(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Add boolean ``flag``: the (non-null) key occurs on more than one row."""
    counts = (df.where(F.coalesce(*[F.col(k).isNotNull() for k in keys]) if len(keys) == 1
                       else F.lit(True))
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
              .where(F.col("__n") > 1).select(*keys, F.lit(True).alias(flag)))
    return (df.join(counts, on=keys, how="left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def flag_missing_parent(df: DataFrame, key: str, parent: DataFrame, parent_key: str, flag: str) -> DataFrame:
    """Add boolean ``flag``: non-null ``key`` not present in ``parent``."""
    present = parent.select(F.col(parent_key).alias(key)).distinct().withColumn("__present", F.lit(True))
    return (df.join(present, on=key, how="left")
            .withColumn(flag, F.col(key).isNotNull() & F.col("__present").isNull())
            .drop("__present"))


def detect_customers(df: DataFrame, now: str = DEFAULT_NOW) -> DataFrame:
    """T01 detector over the customers schema (columns present are checked)."""
    cols = set(df.columns)
    digital = F.col("customer_type").isin(DIGITAL_TYPES)
    rules: list[tuple[str, Column]] = []
    for c in ["customer_name", "email", "gender", "age", "region", "area"]:
        if c in cols:
            rules.append((f"missing {c}", digital & F.col(c).isNull()))
    d = df
    if "email" in cols:
        d = flag_repeated(d, ["email"], "__dup_email")
        rules += [("duplicate email", F.col("__dup_email")),
                  ("email formatting anomaly", F.col("email") != F.lower(F.trim(F.col("email"))))]
    if "signup_date" in cols:
        rules.append(("future signup date", F.col("signup_date") > F.lit(now).cast("timestamp_ntz")))
    if "dob" in cols:
        rules.append(("invalid date of birth", (F.col("dob") > F.lit(now).cast("timestamp_ntz"))
                      | (F.col("dob") < F.lit("1900-01-01").cast("date"))))
        if "signup_date" in cols:
            rules.append(("underage date of birth", F.col("dob") > F.add_months(F.col("signup_date"), -216)))
    if "loyalty_points" in cols:
        rules.append(("negative loyalty points", F.col("loyalty_points") < 0))
    if "gender" in cols:
        rules.append(("invalid gender value", ~F.col("gender").isin("Female", "Male")))
    if "customer_segment" in cols:
        rules.append(("missing customer segment", digital & F.col("customer_segment").isNull()))
    if "customer_name" in cols:
        rules.append(("customer name formatting anomaly", F.col("customer_name") != F.trim(F.col("customer_name"))))
    out = add_labels(d, rules)
    return out.drop("__dup_email") if "email" in cols else out


def detect_products(df: DataFrame) -> DataFrame:
    """T02 detector over the products schema."""
    d = flag_repeated(df, ["product_name"], "__dup_name")
    rules = [
        ("zero or negative selling price", F.col("selling_price") <= 0),
        ("margin inversion", F.col("cost_price") > F.col("selling_price")),
        ("extreme outlier price", F.col("selling_price") >= 10000),
        ("missing brand", F.col("brand").isNull()),
        ("product name formatting anomaly", (F.col("product_name") != F.trim(F.col("product_name")))
         | ((F.col("product_name") == F.upper(F.col("product_name"))) & (F.col("product_name") != F.lower(F.col("product_name"))))),
        ("duplicate product name", F.col("__dup_name")),
    ]
    return add_labels(d, rules).drop("__dup_name")


def detect_transactions(df: DataFrame, now: str = DEFAULT_NOW) -> DataFrame:
    """T13 detector over the transactions schema (header totals if present)."""
    cols = set(df.columns)
    d = flag_repeated(df, ["transaction_id"], "__dup_id")
    rules: list[tuple[str, Column]] = []
    if {"cart_subtotal", "transaction_total"} <= cols:
        def z(c):
            return F.coalesce(F.col(c), F.lit(0)) if c in cols else F.lit(0)
        expected = F.col("cart_subtotal") - z("total_discount") + z("shipping_fee") - z("shipping_discount")
        rules.append(("calculation mismatch", F.abs(expected - F.col("transaction_total")) > 0.02))
        rules.append(("zero cart subtotal for completed order", F.col("cart_subtotal") == 0))
    rules += [
        ("negative transaction total", F.col("transaction_total") < 0),
        ("missing customer ID", F.col("customer_id").isNull()),
        ("duplicate transaction id", F.col("__dup_id")),
        ("invalid payment method", ~F.col("payment_method").isin(PAYMENT_METHODS)),
        ("future transaction time", F.col("transaction_time") > F.lit(now).cast("timestamp_ntz")),
    ]
    if {"basket_size", "items_quantity"} <= cols:
        rules.append(("basket size mismatch", F.col("basket_size") != F.col("items_quantity")))
    if {"shipping_discount", "shipping_fee"} <= cols:
        rules.append(("shipping discount greater than shipping fee", F.col("shipping_discount") > F.col("shipping_fee")))
    return add_labels(d, rules).drop("__dup_id")


def detect_transaction_items(df: DataFrame, transactions: DataFrame | None = None) -> DataFrame:
    """T14 detector over the transaction_items schema."""
    cols = set(df.columns)
    d = df
    rules: list[tuple[str, Column]] = []
    if transactions is not None:
        d = flag_missing_parent(d, "transaction_id", transactions, "transaction_id", "__orphan")
        rules.append(("orphaned transaction item", F.col("__orphan")))
    rules += [("zero unit price", F.col("unit_price") == 0),
              ("invalid quantity", F.col("quantity") <= 0)]
    if "item_discount" in cols:
        rules.append(("item discount greater than item subtotal", F.col("item_discount") > F.col("item_subtotal")))
        if "final_item_price" in cols:
            rules.append(("final item price mismatch",
                          F.abs(F.col("final_item_price") - (F.col("item_subtotal") - F.col("item_discount"))) > 0.02))
    rules.append(("missing product ID", F.col("product_id").isNull()))
    out = add_labels(d, rules)
    return out.drop("__orphan") if transactions is not None else out


def repeats(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """``df`` with ``out``: how many rows hold the same values in ``cols``; a grouped count joined back, nulls equal."""
    n = df.groupBy(*[F.col(c).alias(f"__r_{c}") for c in cols]).agg(F.count(F.lit(1)).alias(out))
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return df.join(n, same, "left").drop(*[f"__r_{c}" for c in cols])
