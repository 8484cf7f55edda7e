"""Scalar functions applied to the driver-derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit import functions as fx
from aislekit.plans.registry import query

CS = ("clickstreams",)


@query("f01_time_of_day", CS, """
SELECT event_id, CASE WHEN hour(event_timestamp) < 5 THEN 'Late Night' WHEN hour(event_timestamp) < 8 THEN 'Early Morning'
  WHEN hour(event_timestamp) < 12 THEN 'Morning' WHEN hour(event_timestamp) < 17 THEN 'Afternoon'
  WHEN hour(event_timestamp) < 21 THEN 'Evening' WHEN event_timestamp IS NOT NULL THEN 'Night' END AS time_of_day
FROM clickstreams""")
def f01(t):
    """Time-of-day band of every click event."""
    return t.view("clickstreams").select("event_id", fx.time_of_day(F.col("event_timestamp")).alias("time_of_day"))


@query("f02_day_type", CS, """
SELECT event_id, CASE WHEN isodow(event_timestamp) >= 6 THEN 'Weekend' WHEN event_timestamp IS NOT NULL THEN 'Weekday' END AS day_type
FROM clickstreams""")
def f02(t):
    """Weekday / weekend of every click event."""
    return t.view("clickstreams").select("event_id", fx.day_type(F.col("event_timestamp")).alias("day_type"))


@query("f03_pay_cycle", ("transactions",), """
SELECT transaction_id, CASE WHEN day(transaction_time) IN (1, 15) THEN 'Payday'
  WHEN day(transaction_time) IN (28, 29, 30, 31, 2) THEN 'Payday Spillover' END AS pay_cycle
FROM transactions""")
def f03(t):
    """Pay-cycle label of every transaction date."""
    return t.view("transactions").select("transaction_id", fx.pay_cycle(F.col("transaction_time")).alias("pay_cycle"))


def _season_values() -> str:
    rows = []
    rank = 0
    for stype, seasons in fx.SEASONAL_DATES.items():
        for season, dates in seasons.items():
            for d in dates:
                rows.append(f"(DATE '{d}', '{season}', '{stype}', {rank})")
                rank += 1
    return "VALUES " + ", ".join(rows)


@query("f04_seasonal_event", CS, f"""
SELECT c.event_id, s.season, s.season_type
FROM clickstreams c LEFT JOIN (SELECT * FROM ({_season_values()}) v(event_date, season, season_type, season_rank)) s
  ON CAST(c.event_timestamp AS DATE) = s.event_date
""")
def f04(t):
    """Seasonal event (and its type) on the calendar date of each click event."""
    dim = fx.seasonal_dimension(t.spark)
    first = dim.groupBy("event_date").agg(F.min(F.struct("season_rank", "season", "season_type")).alias("s"))
    return (t.view("clickstreams").select("event_id", F.to_date("event_timestamp").alias("d"))
            .join(F.broadcast(first), F.col("d") == F.col("event_date"), "left")  # 21 fixed rows
            .select("event_id", F.col("s.season").alias("season"), F.col("s.season_type").alias("season_type")))


@query("f05_overlaps", ("transactions", "transaction_items", "promotions"), """
SELECT i.transaction_id, i.product_id,
  EXISTS (SELECT 1 FROM promotions p WHERE p.promotion_scope = 'product' AND p.promotion_target_id = CAST(i.product_id AS VARCHAR(20))
          AND CAST(t.transaction_time AS DATE) <= p.effective_end_date AND CAST(t.transaction_time AS DATE) >= p.effective_start_date) AS on_promotion
FROM transaction_items i JOIN transactions t USING (transaction_id)
""")
def f05(t):
    """Whether each sold line's date overlaps any promotion window of its product."""
    windows = (t.view("promotions").where(F.col("promotion_scope") == "product")
               .groupBy(F.col("promotion_target_id").alias("target"))
               .agg(F.collect_list(F.struct(F.col("effective_start_date").alias("start"),
                                            F.col("effective_end_date").alias("end"))).alias("windows")))
    lines = (t.view("transaction_items").select("transaction_id", "product_id")
             .join(t.view("transactions").select("transaction_id", F.to_date("transaction_time").alias("d")),
                   "transaction_id"))
    j = lines.join(windows, F.col("product_id").cast("string") == F.col("target"), "left")
    return j.select("transaction_id", "product_id",
                    F.coalesce(fx.overlaps_any(F.col("windows"), F.col("d"), F.col("d")), F.lit(False)).alias("on_promotion"))


@query("f06_slugify", ("products",), """
SELECT product_id, regexp_replace(regexp_replace(replace(lower(concat(product_name, ' & ', brand)), '&', 'and'), '[^\\w\\s-]', '', 'g'), '\\s+', '-', 'g') AS slug
FROM products""")
def f06(t):
    """URL slug of product name and brand."""
    p = t.view("products")
    return p.select("product_id", fx.slugify(F.concat_ws(" & ", "product_name", "brand")).alias("slug"))


_NET_SQL = """CASE product_id % 5 WHEN 0 THEN 'Loose' WHEN 1 THEN CAST(pack_size AS VARCHAR(20)) || 'kg'
 WHEN 2 THEN CAST(pack_size * 10 AS VARCHAR(20)) || 'g' WHEN 3 THEN CAST(pack_size * 10 AS VARCHAR(20)) || 'ml' ELSE CAST(pack_size AS VARCHAR(20)) || 'L' END"""
_PACK_SQL = """CASE product_id % 3 WHEN 0 THEN CAST(pack_size % 13 AS VARCHAR(20)) || '-pack' WHEN 1 THEN NULL ELSE 'single' END"""


def _net_text(p):
    return p.selectExpr("*", f"{_NET_SQL} AS net_content", f"{_PACK_SQL} AS pack_quantity")


@query("f08_parse_net_content", ("products",), f"""
SELECT product_id, CASE WHEN net IS NULL THEN NULL WHEN net = 'Loose' THEN 1.0
  WHEN lower(trim(net)) LIKE '%kg' THEN TRY_CAST(trim(left(lower(trim(net)), length(lower(trim(net))) - 2)) AS DOUBLE) * 1000
  WHEN lower(trim(net)) LIKE '%g' THEN TRY_CAST(trim(left(lower(trim(net)), length(lower(trim(net))) - 1)) AS DOUBLE)
  WHEN lower(trim(net)) LIKE '%ml' THEN TRY_CAST(trim(left(lower(trim(net)), length(lower(trim(net))) - 2)) AS DOUBLE)
  WHEN lower(trim(net)) LIKE '%l' THEN TRY_CAST(trim(left(lower(trim(net)), length(lower(trim(net))) - 1)) AS DOUBLE) * 1000 END AS net_value
FROM (SELECT product_id, {_NET_SQL} AS net FROM products)""")
def f08(t):
    """Net content in grams / millilitres from size text."""
    return _net_text(t.view("products")).select("product_id", fx.parse_net_content(F.col("net_content")).alias("net_value"))


@query("f09_parse_pack_quantity", ("products",), f"""
SELECT product_id, CASE WHEN pq IS NULL OR NOT regexp_matches(pq, '^(\\d+)-pack') THEN 1 ELSE CAST(regexp_extract(pq, '^(\\d+)-pack', 1) AS INTEGER) END AS units
FROM (SELECT product_id, {_PACK_SQL} AS pq FROM products)""")
def f09(t):
    """Units per pack from pack text."""
    return _net_text(t.view("products")).select("product_id", fx.parse_pack_quantity(F.col("pack_quantity")).alias("units"))


@query("f13_discount_code", ("promotions",), """
SELECT promotion_id, concat_ws('_', upper(promotion_mechanic), nullif(promotion_target_id, ''),
  CASE WHEN promotion_mechanic <> 'free_shipping' AND promotion_value IS NOT NULL AND promotion_value <> 0
       THEN CAST(CAST(floor(promotion_value) AS BIGINT) AS VARCHAR(20)) END) AS discount_code
FROM promotions""")
def f13(t):
    """Structured discount code of every promotion."""
    p = t.view("promotions")
    return p.select("promotion_id", fx.discount_code(F.col("promotion_mechanic"), F.col("promotion_scope"),
                                                     F.col("promotion_target_id"), F.col("promotion_value")).alias("discount_code"))


@query("f14_min_spend", ("promotions",), """
SELECT promotion_id, CASE WHEN promotion_mechanic = 'free_shipping' THEN 80.0
  WHEN promotion_scope = 'category' AND promotion_mechanic = 'dollar_discount' THEN greatest(0.0, CAST(promotion_value AS DOUBLE) * 2.0) END AS min_spend
FROM promotions""")
def f14(t):
    """Minimum spend rule by mechanic and scope."""
    p = t.view("promotions")
    return p.select("promotion_id", fx.min_spend(F.col("promotion_mechanic"), F.col("promotion_scope"),
                                                 F.col("promotion_value")).alias("min_spend"))


@query("f15_safe_window", ("promotions",), """
SELECT promotion_id, greatest(effective_start_date, least(effective_end_date, DATE '1999-06-30')) AS safe_end FROM promotions""")
def f15(t):
    """Promotion end clipped to a limit date, never before its start."""
    p = t.view("promotions")
    return p.select("promotion_id", fx.safe_window_end(F.col("effective_start_date"), F.col("effective_end_date"),
                                                       F.lit("1999-06-30").cast("date")).alias("safe_end"))


@query("f17_bundle_quantity", ("bundle_items",), """
SELECT bundle_id, product_id, CASE WHEN regexp_matches(nm, 'Buy (\\d+)') THEN CAST(regexp_extract(nm, 'Buy (\\d+)', 1) AS INTEGER) ELSE 1 END AS buy_quantity
FROM (SELECT bundle_id, product_id, CASE WHEN product_id % 2 = 0 THEN 'Buy ' || CAST(quantity AS VARCHAR(20)) || ' Get 1 Free' ELSE 'Starter Set' END AS nm FROM bundle_items)""")
def f17(t):
    """Required quantity parsed from bundle names."""
    b = t.view("bundle_items")
    nm = F.when(F.col("product_id") % 2 == 0, F.concat(F.lit("Buy "), F.col("quantity").cast("string"), F.lit(" Get 1 Free"))) \
        .otherwise(F.lit("Starter Set"))
    return b.select("bundle_id", "product_id", fx.bundle_quantity(nm).alias("buy_quantity"))


_BAND_SQL = """CASE WHEN delta BETWEEN 0 AND 0 THEN '0' WHEN delta BETWEEN 1 AND 5 THEN '1-5' WHEN delta BETWEEN 6 AND 20 THEN '6-20'
  WHEN delta BETWEEN 21 AND 100 THEN '21-100' WHEN delta BETWEEN 101 AND 10000000 THEN '101+' ELSE 'Overstocked' END"""


@query("f18_stock_band", ("inventory_change_events",), f"""
SELECT store_id, product_id, event_timestamp, {_BAND_SQL} AS stock_band FROM inventory_change_events""")
def f18(t):
    """Stock band of each ledger quantity (out-of-range values are Overstocked)."""
    e = t.view("inventory_change_events")
    return e.select("store_id", "product_id", "event_timestamp", fx.stock_band(F.col("delta")).alias("stock_band"))


@query("f19_stock_status", ("inventory_change_events",), f"""
SELECT store_id, product_id, event_timestamp, coalesce(CASE b WHEN '0' THEN 'Out of Stock' WHEN '1-5' THEN 'Limited Stock'
  WHEN '6-20' THEN 'Low Stock' WHEN '21-100' THEN 'In Stock' WHEN '101+' THEN 'Overstocked' END, '') AS stock_status
FROM (SELECT *, {_BAND_SQL} AS b FROM inventory_change_events)""")
def f19(t):
    """Stock status label of each band ('' for unknown bands)."""
    e = t.view("inventory_change_events")
    return e.select("store_id", "product_id", "event_timestamp", fx.stock_status(fx.stock_band(F.col("delta"))).alias("stock_status"))


@query("f30_search_terms", ("products",), """
WITH w AS (SELECT product_id, list_filter(string_split_regex(trim(concat(category, ' & ', product_name)), '\\s+'), lambda x: x <> '&' AND x <> '') AS words FROM products),
t AS (SELECT product_id, replace(unnest(words), '&', '') AS term FROM w
      UNION ALL
      SELECT product_id, replace(words[i] || '+' || words[i + 1], '&', '') FROM (SELECT product_id, words, unnest(generate_series(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 2))
SELECT product_id, term FROM t WHERE term <> ''""")
def f30(t):
    """All one- and two-word search terms of category and product name."""
    p = t.view("products")
    return p.select("product_id", F.explode(fx.search_terms(F.concat_ws(" & ", "category", "product_name"))).alias("term"))


_PACK_NAME_SQL = """product_name || ' ' || CAST(pack_size AS VARCHAR(20)) || CASE product_id % 4 WHEN 0 THEN '-pack' WHEN 1 THEN 'pk' WHEN 2 THEN ' x' ELSE ' g' END"""


@query("f31_normalise_pack_size", ("products",), f"""
SELECT product_id, regexp_replace(regexp_replace(nm, '(?i)\\b(\\d+)\\s*(?:-\\s*pack|pk|x)\\b', '\\1-pack', 'g'),
  '(?i)\\b(\\d+(?:\\.\\d+)?)\\s+(kg|g|ml|l)\\b', '\\1\\2', 'g') AS normalised
FROM (SELECT product_id, {_PACK_NAME_SQL} AS nm FROM products)""")
def f31(t):
    """Pack-size spellings folded to one form."""
    p = t.view("products").selectExpr("product_id", f"{_PACK_NAME_SQL} AS nm")
    return p.select("product_id", fx.normalise_pack_size(F.col("nm")).alias("normalised"))


_UNIT_NAME_SQL = """product_name || ' ' || CASE product_id % 3 WHEN 0 THEN '1000g' WHEN 1 THEN '1000 ml' ELSE '500g' END"""


@query("f32_normalise_unit", ("products",), f"""
SELECT product_id, regexp_replace(regexp_replace(nm, '(?i)\\b1000\\s*g\\b', '1kg', 'g'), '(?i)\\b1000\\s*ml\\b', '1L', 'g') AS normalised
FROM (SELECT product_id, {_UNIT_NAME_SQL} AS nm FROM products)""")
def f32(t):
    """Unit spellings (1000g / 1kg, 1000ml / 1L) folded to one form."""
    p = t.view("products").selectExpr("product_id", f"{_UNIT_NAME_SQL} AS nm")
    return p.select("product_id", fx.normalise_unit(F.col("nm")).alias("normalised"))


_CASE_NAME_SQL = """CASE product_id % 3 WHEN 0 THEN upper(product_name) WHEN 1 THEN lower(product_name) ELSE product_name END"""


@query("f33_normalise_case", ("products",), f"""
SELECT product_id, array_to_string(list_transform(string_split(lower(trim(nm)), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') AS normalised
FROM (SELECT product_id, {_CASE_NAME_SQL} AS nm FROM products)""")
def f33(t):
    """Upper / lower / title case drift folded to title case."""
    p = t.view("products").selectExpr("product_id", f"{_CASE_NAME_SQL} AS nm")
    return p.select("product_id", fx.normalise_case(F.col("nm")).alias("normalised"))


_SEP_NAME_SQL = """CASE product_id % 4 WHEN 0 THEN replace(product_name, ' ', '_') WHEN 1 THEN replace(product_name, ' ', ' - ') WHEN 2 THEN replace(product_name, ' ', '.') ELSE product_name || '''s' END"""


@query("f34_normalise_separators", ("products",), f"""
SELECT product_id, trim(regexp_replace(translate(nm, '_-.''', '    '), '\\s+', ' ', 'g')) AS normalised
FROM (SELECT product_id, {_SEP_NAME_SQL} AS nm FROM products)""")
def f34(t):
    """Separator drift ('_', '-', '.', quote) folded to single spaces."""
    p = t.view("products").selectExpr("product_id", f"{_SEP_NAME_SQL} AS nm")
    return p.select("product_id", fx.normalise_separators(F.col("nm")).alias("normalised"))


def _desc_sql() -> tuple[str, str]:
    syn = [s for ss in fx.DESCRIPTOR_SYNONYMS.values() for s in ss]
    arr = "[" + ", ".join(f"'{s}'" for s in syn) + "]"
    src = f"product_name || ' ' || {arr}[1 + product_id % {len(syn)}]"
    pairs = sorted(((s, o) for o, ss in fx.DESCRIPTOR_SYNONYMS.items() for s in ss), key=lambda p: -len(p[0]))
    e = "nm"
    for s, o in pairs:
        e = f"regexp_replace({e}, '(?i)\\b{s.replace(' ', '\\s+')}\\b', '{o}', 'g')"
    return src, e


@query("f35_canonical_descriptors", ("products",), f"""
SELECT product_id, {_desc_sql()[1]} AS normalised FROM (SELECT product_id, {_desc_sql()[0]} AS nm FROM products)""")
def f35(t):
    """Descriptor synonyms in listing names mapped back to the original descriptor."""
    syn = [s for ss in fx.DESCRIPTOR_SYNONYMS.values() for s in ss]
    arr = F.array(*[F.lit(s) for s in syn])
    p = t.view("products").select("product_id", F.concat_ws(" ", "product_name", F.element_at(arr, (F.col("product_id") % len(syn) + 1).cast("int"))).alias("nm"))
    return p.select("product_id", fx.canonical_descriptors(F.col("nm")).alias("normalised"))


@query("f37_price_deviation", ("store_catalogues", "products"), """
SELECT s.store_id, s.product_id, round(CAST(s.store_selling_price AS DOUBLE) / nullif(CAST(p.selling_price AS DOUBLE), 0), 4) AS ratio,
  abs(CAST(s.store_selling_price AS DOUBLE) / nullif(CAST(p.selling_price AS DOUBLE), 0) - 1) > 0.15 AS flagged
FROM store_catalogues s JOIN products p USING (product_id)""")
def f37(t):
    """Store price against master price: ratio and +-15% flag."""
    j = t.view("store_catalogues").join(t.view("products").select("product_id", "selling_price"), "product_id")
    d = fx.price_deviation(F.col("store_selling_price"), F.col("selling_price"))
    return j.select("store_id", "product_id", d.alias("d")).select("store_id", "product_id", "d.ratio", "d.flagged")


@query("f40_product_name", ("products",), """
SELECT product_id, concat_ws(' ', nullif(trim(brand), ''), nullif(trim(product_name), ''), nullif(trim(CAST(pack_size AS VARCHAR(20)) || 'g'), ''),
  nullif(trim(CASE WHEN product_id % 2 = 0 THEN '6-pack' END), '')) AS full_name FROM products""")
def f40(t):
    """Display name from brand, item, size and pack, absent parts skipped."""
    p = t.view("products")
    return p.select("product_id", fx.product_name(F.col("brand"), F.col("product_name"), F.concat(F.col("pack_size").cast("string"), F.lit("g")),
                                                  F.when(F.col("product_id") % 2 == 0, F.lit("6-pack"))).alias("full_name"))


@query("f41_rating_sentiment", ("product_reviews",), """
SELECT review_id, CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral' WHEN rating IN (1, 2) THEN 'negative' END AS sentiment
FROM product_reviews""")
def f41(t):
    """Sentiment of each review rating (out-of-range ratings give null)."""
    return t.view("product_reviews").select("review_id", fx.rating_sentiment(F.col("rating")).alias("sentiment"))


@query("f44_scroll_band", CS, """
SELECT event_id, CASE WHEN scroll_depth < 15 THEN '0-15' WHEN scroll_depth < 30 THEN '15-30' WHEN scroll_depth < 50 THEN '30-50'
  WHEN scroll_depth < 75 THEN '50-75' WHEN scroll_depth IS NOT NULL THEN '75-100' END AS scroll_band FROM clickstreams""")
def f44(t):
    """Scroll-depth band of every click event."""
    return t.view("clickstreams").select("event_id", fx.scroll_band(F.col("scroll_depth")).alias("scroll_band"))
