"""Joins and lookups.

Every lookup dictionary of the source is a join here.  Range and
"contains" conditions are turned into equi joins on a derived key (time
bucket, leading characters) with the exact test as residual, so Spark
never falls back to a nested loop over two large sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislekit.functions.pricing import stock_status
from aislekit.operators.intervals import point_in_interval_join
from aislekit.operators.sequence import asof_lookup, numbered, running_sum

DIGITAL_TYPES = ["Online Only", "Omnichannel"]


def with_versions(products: DataFrame, lifecycles: DataFrame) -> DataFrame:
    """Products x lifecycle versions, inner (one row per version)."""
    return products.join(lifecycles, "product_id")


def valid_transactions(headers: DataFrame, items: DataFrame,
                       header_cols=("transaction_id", "customer_id", "store_id", "transaction_time")) -> DataFrame:
    """Four header columns joined to items; an input without the
    needed columns gives an empty frame (decided from the schema)."""
    if not set(header_cols) <= set(headers.columns) or "transaction_id" not in items.columns:
        return items.sparkSession.createDataFrame([], "transaction_id long")
    return headers.select(*header_cols).join(items, "transaction_id")


def area_regions(areas: DataFrame, area: str = "area", region: str = "region") -> DataFrame:
    """The area -> region map as distinct rows."""
    return areas.select(F.col(area).alias("area"), F.col(region).alias("region")).distinct()


def split_stores(stores: DataFrame, online_type: str = "Online") -> DataFrame:
    """Flag the single online store; more or fewer than one online
    store raises at run time (``raise_error`` in the plan)."""
    n = stores.agg(F.count_if(F.col("store_type") == online_type).alias("__n"))
    return (stores.crossJoin(n)  # n is one row
            .select(*stores.columns, F.when(F.col("__n") != 1, F.raise_error(F.lit("expected exactly one online store")))
                    .otherwise(F.col("store_type") == online_type).alias("is_online")))


def store_listing(catalogue: DataFrame, products: DataFrame) -> DataFrame:
    """Store name / category / price with master fallback when the
    store value is missing or falsy (0, ''); rows without a price dropped."""
    p = products.select("product_id", F.col("product_name").alias("__mn"), F.col("category").alias("__mc"),
                        F.col("selling_price").alias("__mp"))
    j = catalogue.join(p, "product_id", "left")
    return j.select("store_id", "product_id",
                    F.coalesce(F.nullif(F.col("store_product_name"), F.lit("")), F.col("__mn")).alias("name"),
                    F.coalesce(F.nullif(F.col("store_category"), F.lit("")), F.col("__mc")).alias("category"),
                    F.coalesce(F.nullif(F.col("store_selling_price"), F.lit(0)), F.col("__mp")).cast("decimal(18,2)").alias("price")
                    ).where(F.col("price").isNotNull())


def bundle_contents(bundle_items: DataFrame, order: str | None = None) -> DataFrame:
    """Bundle -> {product: quantity}; for a repeated product the last
    row (by ``order``, default quantity) wins.  A bundle's member list is
    bounded by its size.  -> (bundle_id, contents map)."""
    o = order or "quantity"
    last = bundle_items.groupBy("bundle_id", "product_id").agg(F.max_by("quantity", o).alias("quantity"))
    return last.groupBy("bundle_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("product_id", "quantity")))).alias("contents"))


def category_members(products: DataFrame) -> DataFrame:
    """Category -> its products, as (category, product_id) rows (a
    category may hold any number of products, so no list is built)."""
    return products.where(F.col("product_id").isNotNull()).select("category", "product_id").distinct()


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """The frame, failing at run time if ``key`` repeats."""
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select(key, F.lit(True).alias("__dup"))
    return (df.join(dup, key, "left")
            .select(*df.columns, F.when(F.col("__dup"), F.raise_error(F.concat(F.lit("duplicate key: "), F.col(key).cast("string"))))
                    .alias("__guard")).drop("__guard"))


def split_by_list(df: DataFrame, col: str, values: list) -> tuple[DataFrame, DataFrame]:
    """(rows whose value is in the list, the others) via semi / anti
    join to the literal list."""
    lst = df.sparkSession.createDataFrame([(v,) for v in values], f"{col} string")
    return (df.join(F.broadcast(lst), col, "left_semi"),  # literal list, size known
            df.join(F.broadcast(lst), col, "left_anti"))


def search_reference(products: DataFrame) -> DataFrame:
    """Categories, then all brands, then all item names; repeats kept."""
    return (products.select(F.col("category").alias("term"))
            .unionAll(products.select(F.col("brand").alias("term")))
            .unionAll(products.select(F.col("product_name").alias("term"))))


def stock_status_asof(probes: DataFrame, snapshots: DataFrame, keys=("store_id", "product_id"),
                      probe_ts: str = "transaction_time", snap_ts: str = "event_timestamp") -> DataFrame:
    """J12 as-of: stock status of the latest snapshot at or before the
    probe time of the same (store, product); 'Out of Stock' when none."""
    return asof_lookup(probes, snapshots, list(keys), probe_ts, snap_ts, "stock_status", "stock_status",
                       default="Out of Stock")


def active_in_window(points: DataFrame, ts: str, intervals: DataFrame, start: str, end: str,
                     keys: list[str] | None = None, distinct_on: list[str] | None = None) -> DataFrame:
    """Intervals holding each point (closed ends), through a
    month-bucketed equi join; optional distinct on columns."""
    j = point_in_interval_join(points, ts, intervals, start, end, keys=keys)
    return j.dropDuplicates(distinct_on) if distinct_on else j


def eligible_for_customer(promotions: DataFrame, treatment_pairs: DataFrame) -> DataFrame:
    """(customer_id, promotion_id) for campaign-linked promotions whose
    campaign has the customer in Treatment; global promotions (no campaign)
    are returned separately with customer_id null (they apply to all)."""
    linked = promotions.where(F.col("campaign_id").isNotNull()).join(
        treatment_pairs.select("campaign_id", "customer_id"), "campaign_id")
    glob = promotions.where(F.col("campaign_id").isNull()).withColumn("customer_id", F.lit(None).cast("long"))
    return linked.select("customer_id", "promotion_id").unionByName(glob.select("customer_id", "promotion_id"))


def active_counts(points: DataFrame, point: str, intervals: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """How many intervals hold each distinct time of ``points`` (closed
    ends): starts so far less ends before, one running sum over times; no
    pairs of points and intervals."""
    ts = lambda c: F.col(c).cast("timestamp_ntz").alias("ts")
    i = intervals.where(F.col(start) <= F.col(end))
    t = points.where(F.col(point).isNotNull()).select(ts(point), F.lit(1).alias("kind"), F.lit(0).alias("d")).distinct()
    u = t.union(i.select(ts(start), F.lit(0), F.lit(1))).union(i.select(ts(end), F.lit(2), F.lit(-1)))
    r = running_sum(u, [], ["ts", "kind"], "d", out)
    return r.where("kind = 1").select("ts", out)


def active_promotions(events: DataFrame, promotions: DataFrame, event_cols: list[str], keys: dict[str, str] | None = None,
                      days: int = 30) -> DataFrame:
    """(event, promotion) pairs where the event's time lies in the promotion's
    dates, both ends included, and ``keys`` (event column -> promotion
    column) agree.  Dates are cut into blocks of ``days``, so the join is an
    equi join on the block and the keys."""
    block = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01")) / days)
    e = events.select(*event_cols, *(keys or {}), F.to_date("event_timestamp").alias("__d")).withColumn("__b", block(F.col("__d")))
    p = promotions.select("promotion_id", *(keys or {}).values(), "effective_start_date", "effective_end_date").withColumn(
        "__b", F.explode(F.sequence(block(F.col("effective_start_date")), block(F.col("effective_end_date")))))
    on = ["__b"]
    for a, b in (keys or {}).items():
        p = p.withColumnRenamed(b, a)
        on.append(a)
    return (e.join(p, on).where(F.col("__d").between(F.col("effective_start_date"), F.col("effective_end_date")))
            .select(*event_cols, "promotion_id"))


def page_promotions(events: DataFrame, promotions: DataFrame, bundle_items: DataFrame) -> DataFrame:
    """Promotions active at the time of a page and relevant on it: cart
    scope by page type, category by the viewed product's category, product
    by product, bundle by membership; one equi join per scope, then a union."""
    p = promotions.where("effective_start_date <= effective_end_date")
    scope = lambda s: p.where(F.col("promotion_scope") == s)
    e = events.withColumn("__pid", F.col("product_id").cast("string")).withColumn("__cat", F.col("category"))
    views = e.where(F.col("event_type") == "Product View")
    cart = active_promotions(e.where(F.col("event_type").isin("Cart View", "Checkout Start")), scope("cart"), ["event_id"])
    cat = active_promotions(e.where(F.col("event_type").isin("Category View", "Product View")), scope("category"),
                            ["event_id"], {"__cat": "promotion_target_id"})
    prod = active_promotions(views, scope("product"), ["event_id"], {"__pid": "promotion_target_id"})
    members = bundle_items.select(F.col("bundle_id").cast("string").alias("__b_id"), F.col("product_id").cast("string").alias("__pid"))
    bun = active_promotions(views.join(members, "__pid"), scope("bundle"), ["event_id"], {"__b_id": "promotion_target_id"})
    return cart.unionByName(cat).unionByName(prod).unionByName(bun).distinct()


def on_sale_through(products: DataFrame, windows: DataFrame, w_start: str, w_end: str, key: str) -> DataFrame:
    """(window key, product) where launch <= window start and the
    product is not discontinued before the window end.  Lives are clipped to
    the windows' range first; lives and windows then meet on the month in
    which a window starts."""
    month = lambda c: F.year(c) * 12 + F.month(c)
    w = windows.where(F.col(w_start).isNotNull()).select(key, w_start, w_end, month(w_start).alias("__m"))
    span = w.agg(F.min("__m").alias("__lo"), F.max("__m").alias("__hi"))  # one row
    p = products.where(F.col("launch_date").isNotNull()).crossJoin(F.broadcast(span))
    first = F.greatest(month("launch_date"), F.col("__lo"))
    last = F.least(F.coalesce(month("discontinuation_date"), F.col("__hi")), F.col("__hi"))
    p = p.where(first <= last).withColumn("__m", F.explode(F.sequence(first, last)))
    j = p.join(w, "__m").where((F.col("launch_date") <= F.col(w_start))
                               & (F.col("discontinuation_date").isNull() | (F.col("discontinuation_date") >= F.col(w_end))))
    return j.select(key, "product_id")


def windows_around(outer: DataFrame, o_start: str, o_end: str, inner: DataFrame, i_start: str, i_end: str,
                   keys: list[str]) -> DataFrame:
    """Rows of ``outer`` whose window holds the whole window of a row of ``inner`` with equal ``keys``.

    The outer windows are cut to the months in which inner windows start, and
    meet them there; each pair meets once.
    """
    month = lambda c: F.year(c) * 12 + F.month(c)
    i = inner.where(F.col(i_start).isNotNull()).withColumn("__m", month(i_start))
    span = i.agg(F.min("__m").alias("__lo"), F.max("__m").alias("__hi"))  # one row
    o = outer.where(F.col(o_start).isNotNull() & F.col(o_end).isNotNull()).crossJoin(F.broadcast(span))
    first, last = F.greatest(month(o_start), F.col("__lo")), F.least(month(o_end), F.col("__hi"))
    o = o.where(first <= last).withColumn("__m", F.explode(F.sequence(first, last))).drop("__lo", "__hi")
    return o.join(i, ["__m", *keys]).where((F.col(o_start) <= F.col(i_start)) & (F.col(o_end) >= F.col(i_end))).drop("__m")


def in_stock_products(probes: DataFrame, snapshots: DataFrame, products: DataFrame) -> DataFrame:
    """(store, product, t) probes whose as-of status is not Out of
    Stock, with the product's category."""
    s = stock_status_asof(probes, snapshots, probe_ts="at")
    return s.where(F.col("stock_status") != "Out of Stock").join(products.select("product_id", "category"), "product_id")


def name_contains(terms: DataFrame, term: str, names: DataFrame, name: str, key_len: int = 3) -> DataFrame:
    """(term, name row) where the lower-case name contains the
    lower-case term literally; null names never match.

    An inverted index: the grams of ``key_len`` characters that terms hold (or
    the whole term when shorter) are counted over the names first, and a term
    meets names on the rarest of its grams only, so a prefix or a gram that
    many names share doesn't fan out while the term holds a rarer one.  The
    exact ``contains`` is the residual.
    """
    t = terms.select(F.col(term).alias("__term")).where(F.col("__term").isNotNull() & (F.col("__term") != "")).distinct()
    t = t.withColumn("__lt", F.lower("__term"))
    n = names.where(F.col(name).isNotNull()).withColumn("__ln", F.lower(F.col(name)))

    def grams(c: str, k: int) -> Column:
        last = F.length(c) - k + 1
        return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(c, i, k)))) \
            .otherwise(F.array().cast("array<string>"))

    tg = t.select("__term", "__lt", F.explode(F.when(F.length("__lt") < key_len, F.array("__lt")).otherwise(grams("__lt", key_len))).alias("__k"))
    wanted = tg.select("__k").distinct()
    ng = n.select("*", F.explode(F.flatten(F.array(*[grams("__ln", k) for k in range(1, key_len + 1)]))).alias("__k"))
    ng = ng.join(wanted, "__k", "left_semi")
    counts = ng.groupBy("__k").agg(F.count(F.lit(1)).alias("__c"))
    key = (tg.join(counts, "__k", "left").groupBy("__term", "__lt")
           .agg(F.min(F.struct(F.coalesce("__c", F.lit(0)).alias("c"), F.col("__k").alias("k"))).alias("__rarest")))
    key = key.where(F.col("__rarest.c") > 0).select("__term", "__lt", F.col("__rarest.k").alias("__k"))  # a gram no name holds: no match
    j = ng.join(key, "__k").where(F.col("__ln").contains(F.col("__lt")))
    return j.select(F.col("__term").alias("term"), *names.columns).distinct()


def payment_successes(events: DataFrame) -> DataFrame:
    """Successful payment events; empty when there is no event type."""
    if "event_type" not in events.columns:
        return events.limit(0)
    return events.where(F.col("event_type") == "Payment Successful")


def stockouts_by_key(stockouts: DataFrame) -> DataFrame:
    """Stockout windows per (store, product) as a sorted list.  The
    list is bounded: non-overlapping windows of one key are at most one
    per day of the data window."""
    return stockouts.groupBy("store_id", "product_id").agg(
        F.sort_array(F.collect_list(F.struct("stockout_start_date", "stockout_end_date"))).alias("windows"))


def competitor_catalogue(listings: DataFrame, competitor: str = "competitor") -> DataFrame:
    """Drop repeats on (competitor, product_id), then on (competitor,
    name), keeping the first by name / id; is_exclusive = no product id.
    A missing id is no id in common: exclusives are repeats by name only.
    Grouped minima, not windows."""
    cols = [c for c in listings.columns if c not in (competitor, "product_id")]
    order = [competitor, "product_id", *cols]
    listed = listings.where(F.col("product_id").isNotNull())
    a = listed.groupBy(competitor, "product_id").agg(F.min(F.struct(F.col("product_name").alias("__n"), *cols)).alias("__f"))
    a = a.select(competitor, "product_id", *[F.col(f"__f.{c}").alias(c) for c in cols])
    a = a.unionByName(listings.where(F.col("product_id").isNull()).select(*order))
    rest = [c for c in order if c not in (competitor, "product_name")]
    b = a.groupBy(competitor, "product_name").agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("__f"))
    return b.select(competitor, "product_name", *[F.col(f"__f.{c}").alias(c) for c in rest]) \
        .withColumn("is_exclusive", F.col("product_id").isNull())


def pick_store(customers: DataFrame, stores: DataFrame, seed: int = 7, rank_key: Column | None = None) -> DataFrame:
    """One store per customer: among retail stores of the customer's
    area, else among all retail stores, the one at position
    hash(customer, seed) mod n.  Stores are numbered per area, and all of them
    in key ranges with running totals, so the pick is an equi join on (area,
    position) or on the position: no customer x store pairs.
    ``rank_key`` replaces the hash (any non-negative integer column)."""
    retail = stores.where(F.col("store_type") != "Online")
    by_area = retail.select("store_id", "area", F.row_number().over(Window.partitionBy("area").orderBy("store_id")).alias("__pos"))
    n_area = by_area.groupBy("area").agg(F.count(F.lit(1)).alias("__n"))
    allr = numbered(retail.select("store_id"), ["store_id"], "__pos")
    n_all = retail.agg(F.count(F.lit(1)).alias("__na"))
    h = rank_key if rank_key is not None else F.abs(F.xxhash64(F.col("customer_id"), F.lit(seed)))
    c = customers.select("customer_id", "area", h.alias("__h")).join(n_area, "area", "left").crossJoin(n_all)  # n_all is one row
    h = F.col("__h")
    c = c.select("customer_id", "area", "__n", (h % F.coalesce("__n", F.lit(1)) + 1).alias("__pa"), (h % F.col("__na") + 1).alias("__pall"))
    in_area = c.join(by_area, (c.area == by_area.area) & (c.__pa == by_area.__pos), "left").select(
        c.customer_id, F.col("store_id").alias("__s1"), c.__pall)
    out = in_area.join(allr, in_area.__pall == allr.__pos, "left").select(
        "customer_id", F.coalesce("__s1", F.col("store_id")).alias("store_id"))
    return out


def digital_customers(customers: DataFrame) -> DataFrame:
    """Online Only and Omnichannel customers."""
    return customers.where(F.col("customer_type").isin(DIGITAL_TYPES))


def review_candidates(headers: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Purchases, first row per (transaction, product), known products only."""
    j = headers.select("transaction_id", "customer_id", "transaction_time").join(
        items.select("transaction_id", "product_id"), "transaction_id")
    return j.join(products.select("product_id"), "product_id", "left_semi").dropDuplicates(["transaction_id", "product_id"])


def launch_lookup(lifecycles: DataFrame) -> DataFrame:
    """Launch and discontinuation by product from the last version.

    Versions that start on the same day are ordered by is_current, then by
    status.
    """
    last = F.struct("valid_from", "is_current", "status")
    return lifecycles.groupBy("product_id").agg(F.max_by("launch_date", last).alias("launch_date"),
                                                F.max_by("discontinuation_date", last).alias("discontinuation_date"))
