"""Clickstream corruption (E07-E17, T12) as column expressions.

Each event draws a corruption budget from its session's noise profile
(E05/E06); the budget picks a hash-random subset of the eight corruption
steps (the step's draw ranks among the eight).  Steps run in a fixed
order, each adding its label under the 4-label cap.  Copies (duplicate
events, bot sessions, orphan sessions) are generated rows unioned back;
they start with their own label only (E18).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislekit.operators.faults import (BOT_EVENTS, BOT_PROB, DUP_PROB, IMPOSSIBLE_EVENTS, MID_FUNNEL_EVENTS,
                                       MISSING_FIELDS, add_error, corruption_budget, draw, session_profile)
from aislekit.operators.profile import ERR
from aislekit.operators.sequence import neighbour

STEPS = ["missing_fields", "populate_wrong_fields", "mismatch_fields", "field_corruption", "time_anomaly",
         "break_cart", "messy_search_term", "wrong_event_sequence"]
CATEGORY_POOL = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
NOW = "2025-01-01 00:00:00"


def session_key() -> Column:
    return F.col("customer_id") * 10000 + F.datediff(F.to_date("event_timestamp"), F.lit("2024-01-01").cast("date"))


def u(seed: int, mode: str) -> Column:
    return draw(F.col("event_id"), seed, mode)


def with_budget(events: DataFrame, mode: str = "xxhash") -> DataFrame:
    """Profile, budget and the chosen steps (``__sel_<step>``) of every event."""
    prof = session_profile(session_key(), 11, mode)
    d = events.withColumn("__profile", prof).withColumn("__budget", corruption_budget(F.col("__profile"), F.col("event_id"), 12, mode))
    pri = [u(40 + i, mode) for i in range(len(STEPS))]
    cols = []
    for i, s in enumerate(STEPS):
        rank = sum((pri[j] < pri[i]).cast("int") for j in range(len(STEPS)) if j != i)
        cols.append((rank < F.col("__budget")).alias(f"__sel_{s}"))
    return d.select("*", *cols)


def _lab(errs: Column, cond: Column, label: str) -> Column:
    return add_error(errs, cond, label)


def apply_steps(d: DataFrame, steps: list[str], mode: str = "xxhash") -> DataFrame:
    """Apply the chosen steps (in the fixed order) to events carrying
    ``__sel_*`` flags."""
    if ERR not in d.columns:
        d = d.withColumn(ERR, F.array().cast("array<string>"))
    for s in steps:
        on = F.col(f"__sel_{s}")
        e = F.col(ERR)
        if s == "missing_fields":
            field = F.element_at(F.array(*[F.lit(f) for f in MISSING_FIELDS]), (F.floor(u(13, mode) * 11) + 1).cast("int"))
            hit = on & (F.size(F.array_distinct(F.col(ERR))) < 4)
            d = d.withColumn("__mf", F.when(hit, field))
            for f in MISSING_FIELDS:
                if f in d.columns:
                    d = d.withColumn(f, F.when(F.coalesce(F.col("__mf") == f, F.lit(False)), F.lit(None)).otherwise(F.col(f)))
            d = d.withColumn(ERR, _lab(e, F.col("__mf").isNotNull(), "__placeholder"))
            d = d.withColumn(ERR, F.transform(F.col(ERR), lambda x: F.when(x == "__placeholder", F.concat(F.lit("missing "), F.col("__mf"))).otherwise(x)))
            d = d.drop("__mf")
        elif s == "populate_wrong_fields":
            c1 = on & F.col("scroll_depth").isNull()
            d = d.withColumn(ERR, _lab(F.col(ERR), c1, "populate scroll depth")).withColumn(
                "scroll_depth", F.when(c1, F.floor(u(50, mode) * 101).cast("double")).otherwise(F.col("scroll_depth")))
            c2 = on & F.col("category").isNull()
            d = d.withColumn(ERR, _lab(F.col(ERR), c2, "populate category")).withColumn(
                "category", F.when(c2, F.element_at(F.array(*[F.lit(x) for x in CATEGORY_POOL]), (F.floor(u(51, mode) * 6) + 1).cast("int")))
                .otherwise(F.col("category")))
            c3 = on & F.col("product_id").isNull()
            d = d.withColumn(ERR, _lab(F.col(ERR), c3, "populate product id")).withColumn(
                "product_id", F.when(c3, F.floor(u(52, mode) * 50).cast("long")).otherwise(F.col("product_id")))
            c4 = on & F.col("cart_size").isNull()
            d = d.withColumn(ERR, _lab(F.col(ERR), c4, "populate cart size")).withColumn(
                "cart_size", F.when(c4, F.floor(u(53, mode) * 21).cast("long")).otherwise(F.col("cart_size")))
        elif s == "mismatch_fields":
            c1 = on & (u(60, mode) < 0.3) & F.col("event_type").isin("Product View", "Add to Cart", "Remove from Cart")
            d = d.withColumn(ERR, _lab(F.col(ERR), c1, "mismatch product")).withColumn(
                "product_id", F.when(c1, F.floor(u(61, mode) * 50).cast("long")).otherwise(F.col("product_id")))
            c2 = on & (u(62, mode) < 0.3) & F.col("cart_size").isNotNull()
            d = d.withColumn(ERR, _lab(F.col(ERR), c2, "mismatch cart size")).withColumn(
                "cart_size", F.when(c2, F.floor(u(63, mode) * 21).cast("long")).otherwise(F.col("cart_size")))
            c3 = on & (u(64, mode) < 0.2) & F.col("scroll_depth").isNotNull()
            d = d.withColumn(ERR, _lab(F.col(ERR), c3, "mismatch scroll depth")).withColumn(
                "scroll_depth", F.when(c3, F.col("scroll_depth") + u(65, mode) * 50 - 25).otherwise(F.col("scroll_depth")))
        elif s == "field_corruption":
            c1 = on & (u(70, mode) < 0.2) & F.col("scroll_depth").isNotNull()
            oob = F.when(u(71, mode) < 0.5, 100.1 + u(72, mode) * 49.9).otherwise(-20 + u(72, mode) * 19.9)
            d = d.withColumn(ERR, _lab(F.col(ERR), c1, "scroll out of bound")).withColumn(
                "scroll_depth", F.when(c1, oob).otherwise(F.col("scroll_depth")))
            c2 = on & (u(73, mode) < 0.3) & F.col("category").isNotNull()
            d = d.withColumn(ERR, _lab(F.col(ERR), c2, "category corruption")).withColumn(
                "category", F.when(c2, F.lit("lorem")).otherwise(F.col("category")))
            c3 = on & (u(74, mode) < 0.2) & F.col("bounce_flag").isNotNull()
            d = d.withColumn(ERR, _lab(F.col(ERR), c3, "bounce flag corruption")).withColumn(
                "bounce_flag", F.when(c3, F.lit("Bounced")).otherwise(F.col("bounce_flag").cast("string")))
            c4 = on & (u(75, mode) < 0.3) & (F.col("event_type") == "Checkout Start")
            d = d.withColumn(ERR, _lab(F.col(ERR), c4, "checkout without cart")).withColumn(
                "cart_size", F.when(c4, F.lit(0).cast("long")).otherwise(F.col("cart_size")))
            c5 = on & (u(76, mode) < 0.03) & (F.col("event_type") == "Add to Cart")
            d = d.withColumn(ERR, _lab(F.col(ERR), c5, "missing add to cart product")).withColumn(
                "product_id", F.when(c5, F.lit(None).cast("long")).otherwise(F.col("product_id")))
        elif s == "time_anomaly":
            prev = F.col("prev_event_timestamp")
            shifts = F.array(1 + F.floor(u(81, mode) * 3), 30 + F.floor(u(81, mode) * 91), 300 + F.floor(u(81, mode) * 901),
                             -(5 + F.floor(u(81, mode) * 296)), 86400 + F.floor(u(81, mode) * 777601))
            shift = F.element_at(shifts, (F.floor(u(82, mode) * 5) + 1).cast("int")).cast("int")
            c1 = on & prev.isNotNull() & (u(80, mode) < 0.3)
            c2 = on & prev.isNotNull() & ~(u(80, mode) < 0.3) & (u(83, mode) < 0.02)
            d = d.withColumn(ERR, _lab(F.col(ERR), c1, "timestamp gap anomaly")).withColumn(
                "event_timestamp", F.when(c1, prev + F.make_interval(secs=shift)).otherwise(F.col("event_timestamp")))
            d = d.withColumn(ERR, _lab(F.col(ERR), c2, "future timestamp")).withColumn(
                "event_timestamp", F.when(c2, F.lit(NOW).cast("timestamp_ntz") + F.make_interval(days=(1 + F.floor(u(84, mode) * 3650)).cast("int")))
                .otherwise(F.col("event_timestamp")))
        elif s == "break_cart":
            r = u(90, mode)
            size = F.col("cart_size")
            c1 = on & (r < 0.3) & (size > 0)
            c2 = on & (r >= 0.3) & (r < 0.9) & (size > 0)
            c3 = on & (r >= 0.9) & (r < 0.95)
            c4 = on & (r >= 0.95) & (size > 0)
            e2 = _lab(_lab(_lab(_lab(F.col(ERR), c1, "partial cart loss"), c2, "cart reset"), c3, "cart is none"), c4, "cart explosion")
            d = d.withColumn(ERR, e2).withColumn("cart_size", F.when(c1, F.floor(size / 2).cast("long")).when(c2, F.lit(0).cast("long"))
                                                 .when(c3, F.lit(None).cast("long")).when(c4, size + 10 + F.floor(u(91, mode) * 21).cast("long"))
                                                 .otherwise(size))
        elif s == "messy_search_term":
            c1 = on & (F.col("event_type") == "Search View")
            d = d.withColumn(ERR, _lab(F.col(ERR), c1, "messy search term")).withColumn(
                "page", F.when(c1, F.concat(F.col("page"), F.lit("!"))).otherwise(F.col("page")))
        elif s == "wrong_event_sequence":
            c1 = on & (u(100, mode) < 0.05)
            d = d.withColumn(ERR, _lab(F.col(ERR), c1, "impossible event sequence")).withColumn(
                "event_type", F.when(c1, F.element_at(F.array(*[F.lit(x) for x in IMPOSSIBLE_EVENTS]), (F.floor(u(101, mode) * 5) + 1).cast("int")))
                .otherwise(F.col("event_type")))
    return d


def duplicate_events(d: DataFrame, mode: str = "xxhash") -> DataFrame:
    """Copy at the profile's duplicate rate, 1-3 s later; the copy
    keeps the row's labels plus 'duplicate event'."""
    rate = F.element_at(F.create_map(*[x for k, v in DUP_PROB.items() for x in (F.lit(k), F.lit(v))]), F.col("__profile"))
    return d.where(u(31, mode) < rate).withColumn(
        "event_timestamp", F.col("event_timestamp") + F.make_interval(secs=(1 + F.floor(u(32, mode) * 3)).cast("int"))).withColumn(
        ERR, F.concat(F.col(ERR), F.array(F.lit("duplicate event"))))


def _made_page(event_type: Column, product_id: Column, category: Column, home: str) -> Column:
    """Page of a made-up event."""
    return (F.when(event_type == "Home View", home).when(event_type == "Search View", "/search?q=term")
            .when(event_type == "Category View", F.concat(F.lit("/category/"), category)).when(event_type == "Cart View", "/cart")
            .when(event_type.isin("Product View", "Add to Cart"), F.concat(F.lit("/product/"), product_id.cast("string")))
            .otherwise("/checkout"))


def _category(u_: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in CATEGORY_POOL]), (F.floor(u_ * len(CATEGORY_POOL)) + 1).cast("int"))


def bot_sessions(d: DataFrame, mode: str = "xxhash") -> DataFrame:
    """E16 (+E18): at the profile's bot rate, a new session of 5-20 rapid events
    (types by fixed weights) after the row; rows carry only 'bot traffic'."""
    rate = F.element_at(F.create_map(*[x for k, v in BOT_PROB.items() for x in (F.lit(k), F.lit(v))]), F.col("__profile"))
    seeds = d.where(u(110, mode) < rate).select("event_id", "customer_id", "event_timestamp",
                                                (5 + F.floor(u(111, mode) * 16)).cast("int").alias("__n"))
    x = seeds.select("*", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("i"))
    k = F.col("event_id") * 100 + F.col("i")
    delay = F.element_at(F.array(0.1 + draw(k, 112, mode) * 0.4, 1 + draw(k, 112, mode) * 4, 10 + draw(k, 112, mode) * 50),
                         (F.floor(draw(k, 113, mode) * 3) + 1).cast("int"))
    x = x.withColumn("__delay_ms", F.floor(delay * 1000).cast("long"))
    w = Window.partitionBy("event_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)  # one seed: at most 20 rows
    tot = sum(w_ for _, w_ in BOT_EVENTS)
    t = draw(k, 114, mode) * tot
    et, acc = None, 0
    for name, wgt in BOT_EVENTS:
        acc += wgt
        et = F.when(t < acc, name) if et is None else et.when(t < acc, name)
    x = x.withColumn("event_type", et).withColumn("__p", F.floor(draw(k, 115, mode) * 50).cast("long")).withColumn("__c", _category(draw(k, 117, mode)))
    view = F.col("event_type")
    return x.select(F.concat(F.lit("bot_"), F.col("event_id").cast("string")).alias("session_id"), "customer_id",
                    (-2 * (F.col("event_id") * 1000 + F.col("i"))).alias("event_id"),  # below all real ids, even
                    (F.col("event_timestamp") + F.make_interval(secs=(F.sum("__delay_ms").over(w) / 1000).cast("decimal(18,3)"))).alias("event_timestamp"),
                    "event_type", F.when(view == "Product View", F.col("__p")).alias("product_id"),
                    F.when(view.isin("Category View", "Product View"), F.col("__c")).alias("category"),
                    F.when(view != "Cart View", draw(k, 116, mode) * 20).alias("scroll_depth"),
                    _made_page(view, F.col("__p"), F.col("__c"), "/").alias("page"),
                    F.col("i").cast("long").alias("event_order"), F.array(F.lit("bot traffic")).alias(ERR))


def orphan_sessions(d: DataFrame, rate: float = 0.02, mode: str = "xxhash") -> DataFrame:
    """E17 (+E18): for a share of sessions, a session of 3-12 mid-funnel events
    10 to 300 seconds apart with no landing event, labelled 'orphan session'."""
    s = d.groupBy("session_id", "customer_id").agg(F.min("event_timestamp").alias("__t"), F.min("event_id").alias("__e"))
    s = s.where(draw(F.col("__e"), 120, mode) < rate).withColumn("__n", (3 + F.floor(draw(F.col("__e"), 121, mode) * 10)).cast("int"))
    x = s.select("*", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("i"))
    k = F.col("__e") * 100 + F.col("i")
    et = F.element_at(F.array(*[F.lit(e) for e in MID_FUNNEL_EVENTS]), (F.floor(draw(k, 122, mode) * len(MID_FUNNEL_EVENTS)) + 1).cast("int"))
    w = Window.partitionBy("__e").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)  # at most 12 rows
    x = (x.withColumn("event_type", et).withColumn("__p", F.floor(draw(k, 123, mode) * 50).cast("long"))
         .withColumn("__c", _category(draw(k, 126, mode))).withColumn("__gap", (10 + F.floor(draw(k, 124, mode) * 291)).cast("int"))
         .withColumn("__scroll", draw(k, 125, mode) * 100))
    view = F.col("event_type")
    return x.select(F.concat(F.lit("orphan_"), F.col("session_id")).alias("session_id"), "customer_id",
                    (-2 * (F.col("__e") * 1000 + F.col("i")) - 1).alias("event_id"),  # below all real ids, odd
                    (F.col("__t") + F.make_interval(secs=F.sum("__gap").over(w).cast("int"))).alias("event_timestamp"), "event_type",
                    F.when(view.isin("Product View", "Add to Cart"), F.col("__p")).alias("product_id"),
                    F.when(view == "Category View", F.col("__c")).alias("category"),
                    F.when(view != "Cart View", F.col("__scroll")).alias("scroll_depth"),
                    F.sum(F.when(view == "Add to Cart", 1).otherwise(0)).over(w).cast("long").alias("cart_size"),
                    _made_page(view, F.col("__p"), F.col("__c"), "/").alias("page"),
                    F.col("i").cast("long").alias("event_order"), F.array(F.lit("orphan session")).alias(ERR))


def dirty_clickstream(enriched: DataFrame, mode: str = "xxhash") -> DataFrame:
    """Every event once (with its chosen corruptions), plus duplicate
    copies, bot sessions and orphan sessions."""
    n = neighbour(enriched, ["session_id"], ["event_timestamp", "event_id"], ["event_timestamp"], "prev",
                  bucket=F.date_trunc("hour", F.col("event_timestamp")))
    b = with_budget(n, mode)
    d = apply_steps(b, STEPS, mode)
    keep = ["event_id", "session_id", "customer_id", "event_timestamp", "event_type", "product_id", "category",
            "scroll_depth", "cart_size", "page", "event_order", ERR]
    base = d.select(*[F.col(c) for c in keep])
    dup = duplicate_events(d, mode).select(*keep)
    bots = bot_sessions(d, mode)
    orph = orphan_sessions(enriched, mode=mode)
    return base.unionByName(dup).unionByName(bots, allowMissingColumns=True).unionByName(orph, allowMissingColumns=True)
