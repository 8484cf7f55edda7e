"""Basket pricing: eligibility, stacking, discount allocation.

The unit of work is a cart (transaction).  Lines are joined to the
promotion dimension by scope key (product, category, bundle), so every
join is an equi join; the time window is a residual.  Per-cart sums are
grouped aggregates (map-side combined), and the sequential stacking rule
is an ``aggregate()`` fold over one cart's sorted candidate array, which
stays in the JVM.  Money is ``decimal(18,2)``; rounding is HALF_UP.
"""

from __future__ import annotations

import os
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislekit.operators.intervals import point_in_interval_join

MONEY = "decimal(18,2)"

# Stacking priority by scope.
STACKING_PRIORITY = {"bundle": 4, "product": 3, "category": 2, "cart": 1}
# Viability caps.
PERCENTAGE_DISCOUNT_MAX_PCT = 40
DOLLAR_DISCOUNT_MAX_RATIO = Decimal("0.40")
# Basket size band -> shopping mission.
MISSION_BANDS = [("Browsing", 1, 2), ("Quick Top Up", 1, 5), ("Regular Buy", 6, 15), ("Bulk Buy", 16, 40)]


def money(c: Column) -> Column:
    return F.round(c.cast("decimal(38,6)"), 2).cast(MONEY)


def cart_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    """Item ids -> (transaction_id, product_id, quantity) lines with the
    product's name, category and price; unknown products are dropped."""
    lines = items.groupBy("transaction_id", "product_id").agg(F.count(F.lit(1)).alias("quantity"))
    p = products.select("product_id", F.coalesce("product_name", F.lit("Unknown Product")).alias("product_name"),
                        "category", F.col("selling_price").cast(MONEY).alias("unit_price"))
    return lines.join(p, "product_id")


def cart_subtotals(lines: DataFrame) -> DataFrame:
    """Cart subtotal = sum(price x quantity) -> (transaction_id, cart_subtotal)."""
    return lines.groupBy("transaction_id").agg(
        money(F.sum(F.col("unit_price") * F.col("quantity"))).alias("cart_subtotal"))


def valid_bundles(lines: DataFrame, bundle_items: DataFrame) -> DataFrame:
    """(transaction_id, bundle_id) where every member is in the cart with
    at least its quantity (relational division; unknown bundles never pass)."""
    need = bundle_items.groupBy("bundle_id").agg(F.count(F.lit(1)).alias("__members"))
    met = (bundle_items.select("bundle_id", "product_id", F.col("quantity").alias("__req"))
           .join(lines.select("transaction_id", "product_id", "quantity"), "product_id")
           .groupBy("transaction_id", "bundle_id")
           .agg(F.count_if(F.col("quantity") >= F.col("__req")).alias("__ok")))
    return met.join(need, "bundle_id").where(F.col("__ok") == F.col("__members")).select("transaction_id", "bundle_id")


def bundle_completions(lines: DataFrame, bundle_items: DataFrame) -> DataFrame:
    """Complete bundle sets in each cart are taken first; remaining
    units per member = quantity - sets x required.
    -> (transaction_id, bundle_id, product_id, complete_sets, remaining_units)."""
    j = (bundle_items.select("bundle_id", "product_id", F.col("quantity").alias("req"))
         .join(lines.select("transaction_id", "product_id", "quantity"), "product_id"))
    sets = (valid_bundles(lines, bundle_items).join(j, ["transaction_id", "bundle_id"])
            .groupBy("transaction_id", "bundle_id")
            .agg(F.min(F.floor(F.col("quantity") / F.col("req"))).cast("long").alias("complete_sets")))
    return (j.join(sets, ["transaction_id", "bundle_id"])
            .select("transaction_id", "bundle_id", "product_id", "complete_sets",
                    (F.col("quantity") - F.col("complete_sets") * F.col("req")).cast("long").alias("remaining_units")))


def timed_carts(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """(transaction_id, transaction_time, cart_subtotal) of the headers' carts that hold lines."""
    return headers.select("transaction_id", "transaction_time").join(cart_subtotals(lines), "transaction_id")


def eligible_promotions(lines: DataFrame, headers: DataFrame, promotions: DataFrame,
                        bundle_items: DataFrame, carts: DataFrame | None = None) -> DataFrame:
    """(transaction_id, promotion_id, scope, mechanic, target, value,
    min_spend, priority) active at the transaction time, min spend null or
    met, and the scope matched by the cart (any line of the product or
    category; the whole bundle present for a bundle).  ``carts`` are the
    written ``timed_carts``, which every scope reads."""
    p = promotions.select("promotion_id", "promotion_scope", "promotion_mechanic", "promotion_target_id",
                          F.col("promotion_value").cast(MONEY).alias("promotion_value"),
                          F.col("min_spend").cast(MONEY).alias("min_spend"), F.col("priority").cast("int").alias("priority"),
                          "effective_start_date", "effective_end_date")
    keys_prod = lines.select("transaction_id", F.col("product_id").cast("string").alias("__t")).distinct()
    keys_cat = lines.select("transaction_id", F.col("category").cast("string").alias("__t")).distinct()
    keys_bun = valid_bundles(lines, bundle_items).select("transaction_id", F.col("bundle_id").cast("string").alias("__t"))

    def scoped(scope: str, keys: DataFrame) -> DataFrame:
        ps = p.where(F.col("promotion_scope") == scope)
        return keys.join(ps, F.col("__t") == F.col("promotion_target_id")).drop("__t")

    # the cart's time and subtotal meet each branch, not their union: a branch keeps its cart's partition
    carts = timed_carts(lines, headers) if carts is None else carts

    def timed(keys: DataFrame) -> DataFrame:
        return keys.join(carts, "transaction_id").where(
            (F.col("effective_start_date") <= F.col("transaction_time")) & (F.col("effective_end_date") >= F.col("transaction_time")))

    parts = [timed(scoped("product", keys_prod)), timed(scoped("category", keys_cat)), timed(scoped("bundle", keys_bun))]
    parts.append(point_in_interval_join(carts, "transaction_time", p.where(F.col("promotion_scope") == "cart"),
                                        "effective_start_date", "effective_end_date").select(*parts[0].columns))
    return (reduce(DataFrame.unionByName, parts)
            .where(F.col("min_spend").isNull() | (F.col("cart_subtotal") >= F.col("min_spend")))
            .drop("effective_start_date", "effective_end_date"))


def active_bundle_price(pairs: DataFrame, bundle_pricings: DataFrame) -> DataFrame:
    """Bundle price active at each (transaction_id, bundle_id, t); among
    overlapping rows the latest start wins (then the lowest pricing id);
    pairs without an active row get null."""
    bp = bundle_pricings.select("bundle_id", "bundle_pricing_id", "bundle_price", "effective_start_date", "effective_end_date")
    j = pairs.join(bp, "bundle_id", "left").where(
        F.col("bundle_pricing_id").isNull()
        | ((F.col("effective_start_date") <= F.col("transaction_time")) & (F.col("effective_end_date") >= F.col("transaction_time"))))
    best = j.groupBy("transaction_id", "bundle_id").agg(
        F.max(F.struct(F.col("effective_start_date"), (-F.col("bundle_pricing_id")).alias("neg_id"),
                       F.col("bundle_price").cast(MONEY).alias("bundle_price"))).alias("__b"))
    return pairs.join(best, ["transaction_id", "bundle_id"], "left").select(*pairs.columns, F.col("__b.bundle_price").alias("bundle_price"))


def promotion_lines(lines: DataFrame, eligible: DataFrame, bundle_items: DataFrame) -> DataFrame:
    """Cart lines each eligible promotion applies to (product: its line;
    category: lines of the category; bundle: lines of bundle members)."""
    l = lines.select(F.col("transaction_id").alias("__lt"), "product_id", "category", "quantity", "unit_price",
                     F.explode(F.array(_claim("product", F.col("product_id")), _claim("category", F.col("category")))).alias("__l"))
    l = l.select("*", F.col("__l.kind").alias("__lk"), F.col("__l.key").alias("__lv")).drop("__l")
    # a bundle claims its members' products, any other promotion its target: one join for all scopes
    members = bundle_items.groupBy(F.col("bundle_id").cast("string").alias("__bid")).agg(
        F.collect_set(F.col("product_id")).alias("__members"))
    scope, target = F.col("promotion_scope"), F.col("promotion_target_id")
    e = eligible.where(scope.isin("product", "category", "bundle")).join(members, (target == F.col("__bid")) & (scope == "bundle"), "left")
    claims = (F.when(scope == "bundle", F.transform("__members", lambda m: _claim("product", m)))
              .otherwise(F.array(F.struct(scope.alias("kind"), target.alias("key")))))
    e = e.select(*eligible.columns, F.explode(claims).alias("__c"))
    out = e.join(l, (F.col("transaction_id") == F.col("__lt")) & (F.col("__c.kind") == F.col("__lk")) & (F.col("__c.key") == F.col("__lv")))
    return out.drop("__lt", "__lk", "__lv", "__c").withColumn("line_total", (F.col("unit_price") * F.col("quantity")).cast("decimal(38,6)"))


def _claim(kind: str, key: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))


def promotion_discounts(lines: DataFrame, headers: DataFrame, eligible: DataFrame, bundle_items: DataFrame,
                        bundle_pricings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B06 + B07 + B08: the discount of every eligible promotion and its
    cent-exact allocation over the lines it applies to.

    Returns (per promotion: transaction_id, promotion_id, ..., discount;
    the promotion lines it covers, for ``allocate``).  All aggregates are
    grouped, not windowed, so one large cart is combined map-side.
    """
    pl = promotion_lines(lines, eligible, bundle_items)
    keys = ["transaction_id", "promotion_id"]
    agg = pl.groupBy(*keys).agg(F.sum("line_total").alias("elig_subtotal"),
                                F.max("product_id").alias("last_pid"),
                                # read for product promotions only, which claim lines of one product
                                F.when(F.count("line_total") == F.count(F.lit(1)), F.min("line_total")).alias("first_total"))
    e = eligible.join(agg, keys, "left")
    # bundle price at the transaction time
    hb = (e.where(F.col("promotion_scope") == "bundle")
          .select("transaction_id", F.col("promotion_target_id").cast("long").alias("bundle_id")).distinct()
          .join(headers.select("transaction_id", "transaction_time"), "transaction_id"))
    bp = active_bundle_price(hb, bundle_pricings).select(
        F.col("transaction_id").alias("__btx"), F.col("bundle_id").cast("string").alias("__bt"), "bundle_price")
    e = e.join(bp, (F.col("transaction_id") == F.col("__btx")) & (F.col("promotion_target_id") == F.col("__bt"))
               & (F.col("promotion_scope") == "bundle"), "left").drop("__btx", "__bt")
    v = F.col("promotion_value")
    sub = F.col("elig_subtotal")
    first = F.round(F.col("first_total"), 2)
    viable = (F.when(F.col("elig_subtotal").isNull(), F.lit(False))
              .when(F.col("promotion_mechanic") == "percentage_discount", v <= PERCENTAGE_DISCOUNT_MAX_PCT)
              .when((F.col("promotion_mechanic") == "dollar_discount") & (F.col("promotion_scope") == "product"),
                    (v < first) & (v <= first * DOLLAR_DISCOUNT_MAX_RATIO))
              .when((F.col("promotion_mechanic") == "dollar_discount") & (F.col("promotion_scope") == "category"),
                    (v < F.round(sub, 2)) & (v <= F.round(sub, 2) * DOLLAR_DISCOUNT_MAX_RATIO))
              .otherwise(F.lit(True)))
    raw = (F.when(F.col("promotion_scope") == "cart", F.lit(0))
           .when(~viable, F.lit(0))
           .when(F.col("promotion_mechanic") == "percentage_discount", sub * v * F.lit(Decimal("0.01")))
           .when(F.col("promotion_mechanic") == "dollar_discount", F.least(v.cast("decimal(38,6)"), sub))
           .when(F.col("promotion_mechanic") == "bundle",
                 F.when(F.col("bundle_price").isNull(), F.lit(0)).otherwise(F.greatest(sub - F.col("bundle_price"), F.lit(0))))
           .otherwise(F.lit(0)))
    per_promo = e.withColumn("discount", F.coalesce(money(raw), F.lit(0).cast(MONEY))).withColumn("viable", viable)
    return per_promo, pl


def allocate(per_promo: DataFrame, pl: DataFrame) -> DataFrame:
    """Non-last lines get round(D x line / eligible subtotal, 2); the
    last line (highest product id) takes D minus the others."""
    keys = ["transaction_id", "promotion_id"]
    d = per_promo.select(*keys, "discount", "elig_subtotal", "last_pid")
    pl2 = pl.select(*keys, "product_id", "line_total").join(d, keys)
    share = money(F.try_divide(F.col("discount") * F.col("line_total"), F.col("elig_subtotal")))
    pl2 = pl2.withColumn("__share", F.when(F.col("product_id") == F.col("last_pid"), F.lit(None).cast(MONEY)).otherwise(share))
    # the join leaves a promotion's lines of a cart together, so its shares are summed where they lie
    others = F.coalesce(F.sum("__share").over(Window.partitionBy(*keys)), F.lit(0))
    return (pl2.withColumn("__others", others)
            .select(*keys, "product_id",
                    F.when(F.col("discount") <= 0, F.lit(0).cast(MONEY))
                    .when(F.col("product_id") == F.col("last_pid"), (F.col("discount") - F.col("__others")).cast(MONEY))
                    .otherwise(F.col("__share")).alias("allocated")))


def promotion_cover(eligible: DataFrame, lines: DataFrame, bundle_items: DataFrame) -> DataFrame:
    """B05 support: the product set each promotion claims in a cart.

    product -> [target]; category -> cart products of that category;
    bundle -> every member of the bundle (cart or not); cart -> [].
    Two promotions overlap exactly when these sets intersect.
    """
    e = eligible.select("transaction_id", "promotion_id", "promotion_scope", "promotion_target_id")
    prod = e.where(F.col("promotion_scope") == "product").select(
        "transaction_id", "promotion_id", F.array(F.col("promotion_target_id")).alias("cover"))
    cat_lines = lines.select(F.col("transaction_id").alias("__lt"), F.col("category").cast("string").alias("__c"),
                             F.col("product_id").cast("string").alias("__p"))
    cat = (e.where(F.col("promotion_scope") == "category")
           .join(cat_lines, (F.col("transaction_id") == F.col("__lt")) & (F.col("promotion_target_id") == F.col("__c")))
           .groupBy("transaction_id", "promotion_id").agg(F.collect_set("__p").alias("cover")))
    members = bundle_items.groupBy(F.col("bundle_id").cast("string").alias("__b")).agg(
        F.collect_set(F.col("product_id").cast("string")).alias("cover"))
    bun = (e.where(F.col("promotion_scope") == "bundle")
           .join(members, F.col("promotion_target_id") == F.col("__b"), "left")
           .select("transaction_id", "promotion_id", F.coalesce("cover", F.array().cast("array<string>")).alias("cover")))
    cart = e.where(F.col("promotion_scope") == "cart").select(
        "transaction_id", "promotion_id", F.array().cast("array<string>").alias("cover"))
    return prod.unionByName(cat).unionByName(bun).unionByName(cart)


def promotion_conflicts(covers: DataFrame) -> DataFrame:
    """For each promotion in a cart, how many of the products it claims
    are also claimed by another promotion of the same cart (> 0 means it
    overlaps).  Counted per (cart, product) with a grouped count, so no
    pairs of promotions are ever formed.
    -> (transaction_id, promotion_id, contested_products, overlaps)."""
    x = covers.select("transaction_id", "promotion_id", F.explode_outer("cover").alias("pid"))
    claims = (x.where(F.col("pid").isNotNull()).groupBy("transaction_id", "pid")
              .agg(F.count_distinct("promotion_id").alias("__claims")))
    j = x.join(claims, ["transaction_id", "pid"], "left")
    out = j.groupBy("transaction_id", "promotion_id").agg(
        F.count_if(F.col("__claims") > 1).alias("contested_products"))
    return out.withColumn("overlaps", F.col("contested_products") > 0)


def overlaps(cover_a: Column, cover_b: Column) -> Column:
    """B05 pair test: two promotions conflict when their claimed product
    sets intersect (cart-scope covers are empty, so never)."""
    return F.arrays_overlap(cover_a, cover_b)


def resolve_stack(per_promo: DataFrame, covers: DataFrame) -> DataFrame:
    """In-store stacking.  Candidates (free shipping excluded) in
    priority order (then promotion id); a newcomer that conflicts with
    chosen ones replaces all of them only when its discount is strictly
    larger than their sum, else it is skipped.  -> selected
    (transaction_id, promotion_id)."""
    c = (per_promo.where(F.col("promotion_mechanic") != "free_shipping")
         .join(covers, ["transaction_id", "promotion_id"])
         .select("transaction_id",
                 F.struct((-F.col("priority")).alias("neg_priority"), F.col("promotion_id"),
                          F.col("discount"), F.col("cover")).alias("c")))
    per_cart = c.groupBy("transaction_id").agg(F.sort_array(F.collect_list("c")).alias("cands"))
    empty = F.array().cast("array<struct<neg_priority:int,promotion_id:bigint,discount:decimal(18,2),cover:array<string>>>")

    def step(acc, p):
        clash = F.filter(acc, lambda s: overlaps(s["cover"], p["cover"]))
        old = F.aggregate(clash, F.lit(0).cast("decimal(28,2)"), lambda a, s: (a + s["discount"]).cast("decimal(28,2)"))
        keep = F.filter(acc, lambda s: ~overlaps(s["cover"], p["cover"]))
        return (F.when(F.size(clash) == 0, F.concat(acc, F.array(p)))
                .when(p["discount"] > old, F.concat(keep, F.array(p)))
                .otherwise(acc))

    chosen = per_cart.select("transaction_id", F.aggregate("cands", empty, step).alias("sel"))
    return chosen.select("transaction_id", F.explode("sel").alias("s")).select(
        "transaction_id", F.col("s.promotion_id").alias("promotion_id"))


def shipping_promo(eligible: DataFrame) -> DataFrame:
    """The eligible free-shipping promotion with the lowest min spend
    (null counts as 0; ties -> lowest id) -> (transaction_id, promotion_id)."""
    fs = eligible.where(F.col("promotion_mechanic") == "free_shipping")
    best = fs.groupBy("transaction_id").agg(
        F.min(F.struct(F.coalesce("min_spend", F.lit(0).cast(MONEY)).alias("ms"), F.col("promotion_id"))).alias("b"))
    return best.select("transaction_id", F.col("b.promotion_id").alias("shipping_promotion_id"))


def shipping_fee(store_is_online: Column, customer_region: Column, store_region: Column,
                 customer_area: Column, store_area: Column, extra: float = 1.0) -> Column:
    """Base 8 online / 4 in store; +8 other region, else +4 other area;
    the 0-2 draw of the source is ``extra``."""
    base = F.when(store_is_online, 8).otherwise(4)
    dist = (F.when(~customer_region.eqNullSafe(store_region), 8)
            .when(~customer_area.eqNullSafe(store_area), 4).otherwise(0))
    return money(base + dist + F.lit(Decimal(str(extra))))


def item_lines(lines: DataFrame, alloc: DataFrame, selected: DataFrame) -> DataFrame:
    """Per line subtotal (rounded), discount = min(allocated over the
    chosen promotions, subtotal), final = max(0, subtotal - discount)."""
    a = (alloc.join(selected, ["transaction_id", "promotion_id"])
         .groupBy("transaction_id", "product_id").agg(F.sum("allocated").alias("__alloc")))
    l = lines.join(a, ["transaction_id", "product_id"], "left")
    sub = money(F.col("unit_price") * F.col("quantity"))
    disc = money(F.least(F.coalesce(F.col("__alloc"), F.lit(0)), sub))
    return l.select(*lines.columns, sub.alias("item_subtotal"), disc.alias("item_discount"),
                    money(F.greatest(F.lit(0), sub - disc)).alias("final_item_price"))


def _cut(df: DataFrame, materialize: bool, by: str | None = None, deal: bool = False) -> DataFrame:
    """Cut lineage after a stage: the stage is written once as parquet in
    the cluster's shared folder (``spark.checkpoint.dir``) and read back, so
    later stages plan against a scan, the stage is computed by one job
    (an RDD checkpoint would compute it twice), and a lost executor never
    recomputes the chain.

    ``by`` writes the stage in buckets of that key: what later meets or is
    grouped within a key needs no shuffle.  ``deal`` first deals the rows to
    their buckets; without it the rows have to lie there already.
    """
    if not materialize:
        return df
    from aislekit.sources.io import shared_path

    spark = df.sparkSession
    path = shared_path(spark, "stages")
    if by is None:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stage_{os.path.basename(path)}"
    (df.repartition(n, by) if deal else df).write.bucketBy(n, by).option("path", path).saveAsTable(name)
    return spark.table(name)


def _cut_scopes(promotions: DataFrame, materialize: bool) -> DataFrame:
    """Promotions written scope by scope, so that a scope's join is planned by the scope's own size."""
    if not materialize:
        return promotions
    known = ("product", "category", "bundle", "cart")
    return reduce(DataFrame.unionByName, [_cut(promotions.where(F.col("promotion_scope") == s), True)
                                          .withColumn("promotion_scope", F.lit(s)) for s in known])


def price_baskets(lines: DataFrame, headers: DataFrame, promotions: DataFrame, bundle_items: DataFrame,
                  bundle_pricings: DataFrame, customers: DataFrame | None = None, stores: DataFrame | None = None,
                  online_store_id=0, fee_extra: float = 1.0, materialize: bool = True) -> dict[str, DataFrame]:
    """B14 / B16 (and the chain B04-B13): priced headers and lines.

    Returns {"eligible", "discounts", "allocation", "selected", "items",
    "transactions", "covers"}.  With ``materialize`` the cart lines, the
    headers, the eligible pairs, the discounts, the claimed products, the
    chosen promotions, the carts' subtotals and the priced lines are written once to the shared
    folder in buckets of the cart, which keeps every later plan small,
    restartable and free of shuffles within a cart; promotions, bundles,
    customers and stores are written too, so that their joins are planned by
    their own size.
    """
    key = "transaction_id"
    if materialize:  # a join within a cart may use the cart's partition
        lines.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    lines = _cut(lines, materialize, key, deal=True)
    headers = _cut(headers, materialize, key, deal=True)
    bundle_items, bundle_pricings = _cut(bundle_items, materialize), _cut(bundle_pricings, materialize)
    carts = _cut(timed_carts(lines, headers), materialize, key)
    elig = _cut(eligible_promotions(lines, headers, _cut_scopes(promotions, materialize), bundle_items, carts), materialize, key, deal=True)
    per_promo, plines = promotion_discounts(lines, headers, elig, bundle_items, bundle_pricings)
    per_promo = _cut(per_promo, materialize, key)
    covers = _cut(promotion_cover(elig, lines, bundle_items), materialize, key)
    # promotions are chosen before anything is allocated; the priced lines are
    # cut too, because headers and checks read them several times
    selected = _cut(resolve_stack(per_promo, covers), materialize, key)
    chosen = per_promo.join(selected, ["transaction_id", "promotion_id"])
    items = _cut(item_lines(lines, allocate(chosen, plines), selected), materialize, key)
    alloc = allocate(per_promo, plines)  # of every eligible promotion; planned only where it is read
    disc = chosen.groupBy("transaction_id").agg(
        F.sum("discount").alias("__d"),
        F.sort_array(F.collect_list(F.when(F.col("discount") > 0, F.struct(
            F.col("promotion_id").cast("string").alias("promotion_id"),
            F.col("promotion_mechanic").alias("promotion_type"),
            F.col("discount").cast("double").alias("amount"))))).alias("__applied"))
    totals = items.groupBy("transaction_id").agg(
        money(F.sum("item_subtotal")).alias("cart_subtotal"),
        F.sum("quantity").cast("long").alias("basket_size"),
        F.count_distinct("product_id").alias("num_unique_items"))
    h = headers.drop("transaction_total", "cart_subtotal", "total_discount", "shipping_fee",
                     "shipping_discount", "basket_size", "num_unique_items", "applied_promotions")
    h = h.join(totals, "transaction_id").join(disc, "transaction_id", "left")
    if customers is not None and stores is not None:
        c = _cut(customers.select("customer_id", F.col("region").alias("__cr"), F.col("area").alias("__ca")), materialize)
        s = _cut(stores.select("store_id", F.col("region").alias("__sr"), F.col("area").alias("__sa")), materialize)
        h = h.join(c, "customer_id", "left").join(s, "store_id", "left")
        fee = shipping_fee(F.col("store_id") == F.lit(online_store_id), F.col("__cr"), F.col("__sr"),
                           F.col("__ca"), F.col("__sa"), fee_extra)
    else:
        fee = shipping_fee(F.col("store_id") == F.lit(online_store_id), F.lit(None), F.lit(None),
                           F.lit(None), F.lit(None), fee_extra)
    ship = shipping_promo(elig)
    h = h.join(ship, "transaction_id", "left").select("*", fee.alias("shipping_fee"))
    td = F.coalesce(money(F.col("__d")), F.lit(0).cast(MONEY))
    total_disc = F.when(td <= 0, F.lit(0).cast(MONEY)).otherwise(td)
    has_ship = F.col("shipping_promotion_id").isNotNull()
    ship_disc = F.when(has_ship, F.col("shipping_fee")).otherwise(F.lit(0).cast(MONEY))
    applied = F.when(total_disc <= 0, F.array()).otherwise(F.coalesce(F.col("__applied"), F.array()))
    ship_entry = F.when(has_ship & (F.col("shipping_fee") > 0), F.array(F.struct(
        F.col("shipping_promotion_id").cast("string").alias("promotion_id"), F.lit("free_shipping").alias("promotion_type"),
        F.col("shipping_fee").cast("double").alias("amount")))).otherwise(F.array())
    out = h.select("*", total_disc.alias("total_discount"), ship_disc.alias("shipping_discount"),
                   money(F.col("cart_subtotal") - total_disc + F.col("shipping_fee") - ship_disc).alias("transaction_total_new"),
                   F.concat(applied, ship_entry).alias("applied_promotions"))
    out = out.drop("transaction_total").withColumnRenamed("transaction_total_new", "transaction_total")
    keep = [c for c in headers.columns if c not in ("transaction_total",)] + [
        "cart_subtotal", "total_discount", "shipping_fee", "shipping_discount", "transaction_total",
        "basket_size", "num_unique_items", "applied_promotions"]
    seen, cols = set(), []
    for c in keep:
        if c not in seen:
            seen.add(c)
            cols.append(c)
    return {"eligible": elig, "discounts": per_promo, "allocation": alloc, "selected": selected,
            "items": items, "transactions": out.select(*cols), "covers": covers}


def reconcile(transactions: DataFrame, items: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Headers whose total differs from sum(final item price) + fee -
    shipping discount by more than the tolerance -> failing rows with detail."""
    s = items.groupBy("transaction_id").agg(money(F.sum("final_item_price")).alias("items_total"))
    j = transactions.join(s, "transaction_id")
    expected = F.col("items_total") + F.col("shipping_fee") - F.col("shipping_discount")
    return j.where(F.abs(F.col("transaction_total") - expected) > tolerance).select(
        "transaction_id", "transaction_total", "items_total", money(expected).alias("expected_total"))


def stacking_priority(scope: Column) -> Column:
    """Bundle 4, product 3, category 2, cart 1."""
    m = F.create_map(*[F.lit(x) for kv in STACKING_PRIORITY.items() for x in kv])
    return F.element_at(m, scope)


def basket_mission(basket_size: Column) -> Column:
    """First mission whose size band holds the basket size."""
    expr = None
    for name, lo, hi in MISSION_BANDS:
        cond = basket_size.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr
