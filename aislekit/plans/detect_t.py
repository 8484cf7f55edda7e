"""Detectors of T03, T06 and T09, and the search-term edits of E13."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import faults as E
from aislekit.operators.profile import ERR
from aislekit.operators.quality import repeats
from aislekit.plans import extended as X
from aislekit.plans.derived import cut
from aislekit.plans.registry import query
from aislekit.sources.catalog import VALUES

_NOW = "2025-01-01"


def _with(ctes: dict, body: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


def _labels(pairs: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN coalesce({c}, false) THEN '{label}' END" for label, c in pairs) + "], lambda x: x IS NOT NULL)"


_T03, _T03_LAST = X._t03_ctes()
_T03_VALUES = [c for c in X.T03_COLUMNS if c != ERR]


@query("t03_competitor_price_history_detect", ("products",), _with(_T03, f"""
SELECT competitor, product_id, batch_week, update_timestamp, error_types, {_labels([
    ("zero or negative scraped price", "scraped_price <= 0"),
    ("price spike greater than 5x", "good > 1 AND scraped_price > 0 AND scraped_price * (good - 1) > 5 * (total - scraped_price)"),
    ("future update timestamp", f"update_timestamp > TIMESTAMP '{_NOW}'"), ("duplicate row", "same > 1"),
    ("missing category", "category IS NULL"), ("promo flag stored as text", "has_active_promo NOT IN ('true', 'false')")])} AS detected
FROM (SELECT *, count(*) OVER (PARTITION BY {', '.join(_T03_VALUES)}) AS same, count(*) FILTER (scraped_price > 0) OVER (PARTITION BY product_id) AS good,
  sum(scraped_price) FILTER (scraped_price > 0) OVER (PARTITION BY product_id) AS total FROM {_T03_LAST})"""))
def t03_detect(t):
    """T03 detector: labels of the faulted price history from its values; a spike stands against the product's other prices."""
    d = cut(t, "__t03", lambda: X.t03(t))
    good = F.when(F.col("scraped_price") > 0, F.col("scraped_price"))
    level = d.groupBy(F.col("product_id").alias("__p")).agg(F.count(good).alias("__good"), F.sum(good).alias("__total"))
    d = repeats(d, _T03_VALUES, "__same").join(level, F.col("product_id").eqNullSafe(F.col("__p")), "left")
    spike = (F.col("__good") > 1) & (F.col("scraped_price") > 0) & (
        F.col("scraped_price") * (F.col("__good") - 1) > 5 * (F.col("__total") - F.col("scraped_price")))
    rules = [("zero or negative scraped price", lambda: F.col("scraped_price") <= 0), ("price spike greater than 5x", lambda: spike),
             ("future update timestamp", lambda: F.col("update_timestamp") > F.lit(_NOW).cast("timestamp_ntz")),
             ("duplicate row", lambda: F.col("__same") > 1), ("missing category", lambda: F.col("category").isNull()),
             ("promo flag stored as text", lambda: ~F.col("has_active_promo").isin("true", "false"))]
    return E.detect(d, rules).select("competitor", "product_id", "batch_week", "update_timestamp", ERR, "detected")


_T06, _T06_LAST = X._t06_ctes()
_T06_VALUES = ["store_id", "product_id", "event_timestamp", "week_start_date", "stock_status", "stock_band"]
_STATUS = ", ".join(f"'{v}'" for v in VALUES["stock_status"])


@query("t06_stock_snapshots_detect", ("inventory_change_events",), _with(_T06, f"""
SELECT store_id, product_id, event_timestamp, error_types, {_labels([
    ("invalid stock status value", f"stock_status NOT IN ({_STATUS})"), ("future week start date", f"week_start_date > DATE '{_NOW}'"),
    ("missing snapshot data", "stock_status IS NULL"), ("duplicate row", "same > 1")])} AS detected
FROM (SELECT *, count(*) OVER (PARTITION BY {', '.join(_T06_VALUES)}) AS same FROM {_T06_LAST})"""))
def t06_detect(t):
    """T06 detector: labels of the faulted stock snapshots from their values."""
    d = repeats(cut(t, "__t06", lambda: X.t06(t)), _T06_VALUES, "__same")
    rules = [("invalid stock status value", lambda: ~F.col("stock_status").isin(VALUES["stock_status"])),
             ("future week start date", lambda: F.col("week_start_date") > F.lit(_NOW).cast("date")),
             ("missing snapshot data", lambda: F.col("stock_status").isNull()), ("duplicate row", lambda: F.col("__same") > 1)]
    return E.detect(d, rules).select("store_id", "product_id", "event_timestamp", ERR, "detected")


_T09_CTES, _T09_LAST = E.plan_sql("bundles_b", X.T09_STEPS, "__rk", [])


@query("t09_bundles_detect", ("bundle_items", "products"), _with({"bundles_b": X.BUNDLE_TABLE_SQL, **_T09_CTES}, f"""
SELECT __rk, bundle_id, error_types, {_labels([
    ("bundle name formatting anomaly", "bundle_name <> trim(bundle_name) OR bundle_name = upper(bundle_name) OR bundle_name = lower(bundle_name)"),
    ("duplicate bundle id", "same > 1")])} AS detected
FROM (SELECT *, count(*) OVER (PARTITION BY bundle_id) AS same FROM {_T09_LAST})"""))
def t09_detect(t):
    """T09 detector: labels of the faulted bundles from their values."""
    d = repeats(cut(t, "__t09", lambda: X.t09(t)), ["bundle_id"], "__same")
    name = F.col("bundle_name")
    rules = [("bundle name formatting anomaly", lambda: (name != F.trim(name)) | (name == F.upper(name)) | (name == F.lower(name))),
             ("duplicate bundle id", lambda: F.col("__same") > 1)]
    return E.detect(d, rules).select("__rk", "bundle_id", ERR, "detected")


def _draw(seed: int, key: str = "product_id") -> str:
    return E.arith_u_sql(key, seed)


_LETTERS = "list_transform(list_sort(list_transform(range(1, length(term) + 1), lambda i: {'u': %s, 'i': i, 'c': substr(term, i, 1)})), lambda x: x.c)" % E.arith_u_sql(
    "concat_ws('-', product_id, i)", 203)
_WORD = "list_transform(range(1, 4 + CAST(floor(%s * 8) AS BIGINT)), lambda i: chr(CAST(97 + floor(%s * 26) AS INTEGER)))" % (
    _draw(204), E.arith_u_sql("concat_ws('-', product_id, i)", 205))


@query("e13_messy_terms", ("products",), f"""
SELECT product_id, term, CASE op WHEN 0 THEN term || ['!', '??', '.'][CAST(floor({_draw(202)} * 3) + 1 AS INTEGER)] WHEN 1 THEN replace(term, 'a', 'aa')
  WHEN 2 THEN CASE WHEN length(term) > 1 THEN substr(term, 1, length(term) - 1) ELSE term END
  WHEN 3 THEN CASE WHEN length(term) > 2 THEN array_to_string({_LETTERS}, '') ELSE term END
  WHEN 4 THEN repeat(' ', 1 + CAST(floor({_draw(204)} * 5) AS INTEGER)) ELSE array_to_string({_WORD}, '') END AS messy, CAST(op AS INTEGER) AS op
FROM (SELECT product_id, string_split(product_name, ' ')[1] AS term, CAST(floor({_draw(201)} * 6) AS INTEGER) AS op FROM products)""")
def e13_terms(t):
    """The six edits of a search term, drawn per product: a mark, doubled a, a lost end, shuffled letters, blanks, random letters."""
    d = t.view("products").select("product_id", F.split("product_name", " ")[0].alias("term"))
    return E.messy_terms(d, "term", F.col("product_id"), "arith")
