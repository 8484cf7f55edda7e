"""Clickstream sessions and sequences.

Order-dependent values (event order, next event, running cart) are
computed per session / customer with the bucketed sequence primitives,
so a very long session is split into hour buckets instead of landing in
one task.  Counting transitions is a grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislekit.functions.text import slugify
from aislekit.operators.sequence import neighbour, running_sum

# Allowed next events with their probabilities.
VALID_EVENT_TRANSITIONS = {
    "Home View": {"Product View": 0.4, "Category View": 0.3, "Search View": 0.25, "Cart View": 0.05},
    "Category View": {"Product View": 0.45, "Search View": 0.2, "Category View": 0.15, "Home View": 0.1, "Cart View": 0.1},
    "Search View": {"Product View": 0.5, "Category View": 0.2, "Search View": 0.15, "Home View": 0.1, "Cart View": 0.05},
    "Product View": {"Add to Cart": 0.25, "Category View": 0.2, "Search View": 0.15, "Home View": 0.15, "Product View": 0.15,
                     "Cart View": 0.1},
    "Add to Cart": {"Cart View": 0.4, "Product View": 0.3, "Category View": 0.2, "Home View": 0.1},
    "Cart View": {"Checkout Start": 0.35, "Product View": 0.25, "Remove from Cart": 0.15, "Home View": 0.15, "Category View": 0.1},
    "Remove from Cart": {"Cart View": 0.5, "Product View": 0.3, "Home View": 0.2},
    "Checkout Start": {"Payment Attempt": 0.7, "Cart View": 0.2, "Home View": 0.1},
    "Payment Attempt": {"Payment Successful": 0.9, "Payment Failed": 0.1},
    "Payment Successful": {"Home View": 0.6, "Category View": 0.4},
    "Payment Failed": {"Payment Attempt": 0.5, "Cart View": 0.3, "Home View": 0.2},
}

# Page template per event type.
EVENT_PAGE_MAPPING = {
    "Home View": "/home",
    "Category View": "/category/{category}",
    "Search View": "/search?q={search_term}",
    "Product View": "/product/{product_id}",
    "Add to Cart": "/add_to_cart/{product_id}",
    "Cart View": "/cart",
    "Remove from Cart": "/remove_from_cart/{product_id}",
    "Checkout Start": "/checkout",
    "Payment Attempt": "/payment",
    "Payment Successful": "/payment/success",
    "Payment Failed": "/payment/fail",
}
ENTRY_EVENTS = ["Home View", "Search View", "Category View", "Product View"]


def hour_bucket(c: str = "event_timestamp") -> Column:
    return F.date_trunc("hour", F.col(c).cast("timestamp_ntz"))


def transition_table(spark) -> DataFrame:
    """The allowed (from, to, probability) table (fixed, 40 rows)."""
    rows = [(a, b, p) for a, m in VALID_EVENT_TRANSITIONS.items() for b, p in m.items()]
    return spark.createDataFrame(rows, "from_event string, to_event string, probability double")


def sort_sessions(events: DataFrame) -> DataFrame:
    """Events ordered by (session, time, id).  A global sort
    range-partitions on the whole key, so one long session spreads over
    several partitions."""
    return events.orderBy("session_id", "event_timestamp", "event_id")


def event_order(events: DataFrame, split: bool = True) -> DataFrame:
    """1-based order inside the session (time, then id) and
    clickstream_id = session '_' 0-based index; a running count bucketed by
    hour (without ``split``, see ``sequence.may_be_hot``, a session is one window)."""
    d = events.withColumn("__one", F.lit(1))
    r = running_sum(d, ["session_id"], ["event_timestamp", "event_id"], "__one", "event_order", bucket=hour_bucket(), split=split)
    return r.drop("__one").withColumn("event_order", F.col("event_order").cast("long")).withColumn(
        "clickstream_id", F.concat_ws("_", F.col("session_id"), (F.col("event_order") - 1).cast("string")))


def bounce_flags(events: DataFrame, split: bool = True) -> DataFrame:
    """bounce_flag 1 on the only event of a one-event session; ``split`` as for ``event_order``."""
    if not split:
        n = F.count(F.lit(1)).over(Window.partitionBy("session_id"))
        return events.withColumn("bounce_flag", F.when(n == 1, 1).otherwise(0))
    n = events.groupBy(F.col("session_id").alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    j = events.join(n, F.col("session_id").eqNullSafe(F.col("__s")), "left")  # events without a session stay
    return j.withColumn("bounce_flag", F.when(F.col("__n") == 1, 1).otherwise(0)).drop("__n", "__s")


def resolve_page(event_type: Column, product_id: Column, category: Column, search_term: Column) -> Column:
    """fill the event's page template: product id first, then the
    category slug, then the search term; unknown events give ''."""
    tmpl = F.element_at(F.create_map(*[F.lit(x) for kv in EVENT_PAGE_MAPPING.items() for x in kv]), event_type)
    t = F.coalesce(tmpl, F.lit(""))
    pid, cat, term = product_id.cast("string"), category, search_term
    return (F.when(t.contains("{product_id}") & pid.isNotNull() & (pid != ""), F.replace(t, F.lit("{product_id}"), pid))
            .when(t.contains("{category}") & cat.isNotNull() & (cat != ""), F.replace(t, F.lit("{category}"), slugify(cat)))
            .when(t.contains("{search_term}") & term.isNotNull() & (term != ""), F.replace(t, F.lit("{search_term}"), term))
            .otherwise(t))


def cart_replay(events: DataFrame, key: str = "customer_id", split: bool = True) -> DataFrame:
    """Running cart per customer across sessions.

    Add to Cart adds its product, Remove from Cart removes it, Payment
    Successful buys the whole cart and empties it.  ``cart_epoch`` counts
    purchases so far; ``cart_size`` is the running (add - remove) count in
    the epoch, bucketed by month so a busy customer stays parallel (without
    ``split`` a customer is one window).
    """
    sign = (F.when(F.col("event_type") == "Add to Cart", 1).when(F.col("event_type") == "Remove from Cart", -1).otherwise(0))
    d = events.withColumn("__buy", F.when(F.col("event_type") == "Payment Successful", 1).otherwise(0)).withColumn("__s", sign)
    d = running_sum(d, [key], ["event_timestamp", "event_id"], "__buy", "cart_epoch", split=split)
    d = running_sum(d, [key, "cart_epoch"], ["event_timestamp", "event_id"], "__s", "cart_size", split=split)
    return d.drop("__buy", "__s").withColumn("cart_size", F.col("cart_size").cast("long"))


def purchased_items(replayed: DataFrame, key: str = "customer_id") -> DataFrame:
    """Items bought at each Payment Successful = the cart of the epoch
    it closes (grouped multiset per (customer, epoch), never a window).
    -> (event_id, purchased_items array<string>, sorted)."""
    sign = F.when(F.col("event_type") == "Add to Cart", 1).when(F.col("event_type") == "Remove from Cart", -1).otherwise(0)
    per = (replayed.where(F.col("event_type").isin("Add to Cart", "Remove from Cart"))
           .groupBy(key, "cart_epoch", "product_id").agg(F.sum(sign).alias("__n")).where(F.col("__n") > 0))
    items = per.groupBy(key, F.col("cart_epoch").alias("__ep")).agg(
        F.sort_array(F.flatten(F.collect_list(F.array_repeat(F.col("product_id").cast("string"), F.col("__n").cast("int"))))).alias("purchased_items"))
    buys = replayed.where(F.col("event_type") == "Payment Successful").select("event_id", key, (F.col("cart_epoch") - 1).alias("__ep"))
    return (buys.join(items, [key, "__ep"], "left")
            .select("event_id", F.coalesce("purchased_items", F.array().cast("array<string>")).alias("purchased_items")))


def next_events(events: DataFrame) -> DataFrame:
    """Next event type in the session (bucketed lead)."""
    return neighbour(events, ["session_id"], ["event_timestamp", "event_id"], ["event_type"], "next", bucket=hour_bucket())


def transition_matrix(events: DataFrame) -> DataFrame:
    """Observed share of each next event per event, with the allowed
    pairs never observed kept at zero.  -> (from_event, to_event, n, share)."""
    n = next_events(events).where(F.col("next_event_type").isNotNull())
    obs = n.groupBy(F.col("event_type").alias("from_event"), F.col("next_event_type").alias("to_event")).agg(
        F.count(F.lit(1)).alias("n"))
    allowed = transition_table(events.sparkSession).select("from_event", "to_event")
    allp = obs.join(allowed, ["from_event", "to_event"], "full").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    tot = allp.groupBy("from_event").agg(F.sum("n").alias("__t"))
    return allp.join(tot, "from_event").select("from_event", "to_event", "n",
                                               F.round(F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("__t")), F.lit(0.0)), 6).alias("share"))


def invalid_transitions(events: DataFrame) -> DataFrame:
    """Observed (from, to) pairs outside the allowed table, counted."""
    n = next_events(events).where(F.col("next_event_type").isNotNull())
    obs = n.groupBy(F.col("event_type").alias("from_event"), F.col("next_event_type").alias("to_event")).agg(F.count(F.lit(1)).alias("n"))
    return obs.join(transition_table(events.sparkSession), ["from_event", "to_event"], "left_anti")


def cart_progress(cart_size: Column, target: Column) -> Column:
    """min(cart / target, 1)."""
    return F.least(cart_size.cast("double") / target, F.lit(1.0))


def time_on_page(events: DataFrame) -> DataFrame:
    """Seconds to the next event of the session (null on the last)."""
    n = neighbour(events, ["session_id"], ["event_timestamp", "event_id"], ["event_timestamp"], "next", bucket=hour_bucket())
    us = F.timestamp_diff("MICROSECOND", F.col("event_timestamp"), F.col("next_event_timestamp"))  # no time zone involved
    return n.withColumn("time_on_page", us / 1e6).drop("next_event_timestamp")


def session_starts(events: DataFrame) -> DataFrame:
    """(customer, session, start, events) per session (grouped)."""
    return events.groupBy("customer_id", "session_id").agg(F.min("event_timestamp").alias("session_start"),
                                                          F.count(F.lit(1)).alias("events"))


def session_gaps(events: DataFrame, cap_hours: int = 24 * 60) -> DataFrame:
    """Whole seconds since the customer's previous session (capped at
    60 days) and a band: short (< 1 day), weekly (< 8 days), long.  The gap
    is exact integer arithmetic on microseconds."""
    s = session_starts(events)
    n = neighbour(s, ["customer_id"], ["session_start", "session_id"], ["session_start"], "prev")
    us = F.timestamp_diff("MICROSECOND", F.col("prev_session_start"), F.col("session_start"))
    g = F.when(F.col("prev_session_start").isNotNull(), F.least(F.floor(us / 1000000).cast("long"), F.lit(cap_hours * 3600)))
    return n.select("customer_id", "session_id", g.alias("gap_seconds"),
                    F.when(g.isNull(), None).when(g < 86400, "short").when(g < 86400 * 8, "weekly").otherwise("long").alias("gap_band"))


def inactive_gap_summary(gaps: DataFrame, customers: DataFrame) -> DataFrame:
    """Log-normal summary of inactive days by segment: mean and sample
    std of log(days) over gaps of at least one day."""
    d = gaps.where(F.col("gap_seconds") >= 86400).select("customer_id", F.log(F.col("gap_seconds") / 86400).alias("__l"))
    return (d.join(customers.select("customer_id", "customer_segment"), "customer_id")
            .groupBy("customer_segment").agg(F.round(F.avg("__l"), 6).alias("log_mean"), F.round(F.stddev_samp("__l"), 6).alias("log_std"),
                                             F.count(F.lit(1)).alias("gaps")))


def activity_multiplier(events: DataFrame, lo: int = 1, hi: int = 10) -> DataFrame:
    """Sessions per customer clipped to [lo, hi]."""
    return events.groupBy("customer_id").agg(F.count_distinct("session_id").alias("sessions")).select(
        "customer_id", F.least(F.greatest(F.col("sessions"), F.lit(lo)), F.lit(hi)).alias("activity_multiplier"))


def session_flags(sessions: DataFrame, exposures: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Per session: ids of the customer's campaigns active at the session
    start, and whether any is Treatment / Control (J14 + collect_set)."""
    a = exposures.select("campaign_id", "customer_id", "assignment_group").distinct()
    c = campaigns.select("campaign_id", "start_date", "end_date")
    ac = a.join(c, "campaign_id")
    j = sessions.join(ac, "customer_id").where((F.col("start_date") <= F.col("session_start")) & (F.col("end_date") >= F.col("session_start")))
    flags = j.groupBy("session_id").agg(F.sort_array(F.collect_set("campaign_id")).alias("campaign_ids"),
                                        F.bool_or(F.col("assignment_group") == "Treatment").alias("has_treatment_campaign"),
                                        F.bool_or(F.col("assignment_group") == "Control").alias("has_control_campaign"))
    return sessions.select("session_id").join(flags, "session_id", "left").select(
        "session_id", F.coalesce("campaign_ids", F.array().cast("array<bigint>")).alias("campaign_ids"),
        F.coalesce("has_treatment_campaign", F.lit(False)).alias("has_treatment_campaign"),
        F.coalesce("has_control_campaign", F.lit(False)).alias("has_control_campaign"))


def location_match(c_area: Column, c_region: Column, s_area: Column, s_region: Column) -> Column:
    """K21: 'home_area' when areas match, 'same_region', else 'elsewhere'."""
    return (F.when(c_area.eqNullSafe(s_area) & c_area.isNotNull(), "home_area")
            .when(c_region.eqNullSafe(s_region) & c_region.isNotNull(), "same_region").otherwise("elsewhere"))


def next_category(events: DataFrame) -> DataFrame:
    """Category -> next category counts and share inside each session."""
    d = events.where(F.col("category").isNotNull())
    n = neighbour(d, ["session_id"], ["event_timestamp", "event_id"], ["category"], "next", bucket=hour_bucket())
    obs = n.where(F.col("next_category").isNotNull()).groupBy(F.col("category").alias("from_category"),
                                                             F.col("next_category").alias("to_category")).agg(F.count(F.lit(1)).alias("n"))
    tot = obs.groupBy("from_category").agg(F.sum("n").alias("__t"))
    return obs.join(tot, "from_category").select("from_category", "to_category", "n", F.round(F.col("n") / F.col("__t"), 6).alias("share"))


def enrich_clickstream(events: DataFrame, products: DataFrame, split: bool = True) -> DataFrame:
    """Clickstream rows in the reference shape: order, id, bounce flag,
    product name / category, page, cart size and purchased items.  Without
    ``split`` (no hot session or customer) there is one shuffle by session
    and one by customer."""
    p = products.select("product_id", "product_name", "category")
    e = events.join(p, "product_id", "left")
    e = event_order(e, split)
    e = bounce_flags(e, split)
    e = e.withColumn("page", resolve_page(F.col("event_type"), F.col("product_id"), F.col("category"), F.lit(None).cast("string")))
    r = cart_replay(e, split=split)
    items = purchased_items(r)
    return (r.join(items, "event_id", "left")
            .withColumn("purchased_items", F.coalesce("purchased_items", F.array().cast("array<string>"))))
