"""Sequence faults of the clickstream (E14) and the detector of inserted sessions.

``sequence_faults`` inserts rows into ordered sessions.  What is inserted is
drawn per event; an earlier page or product view is drawn as a position in the
session, so the pick is an equi join on (session, position) and no session is
gathered.  Inserted rows stand after the event that drew them; the order is
numbered anew by a running count in blocks.

``detect_sessions`` finds duplicate, bot and orphan rows from values alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislekit.operators.click_faults import u
from aislekit.operators.faults import IMPOSSIBLE_EVENTS
from aislekit.operators.profile import ERR
from aislekit.operators.sequence import neighbour, running_sum

# Rates of the four sequence faults.
RATES = {"impossible": 0.05, "repeat": 0.05, "backtrack": 0.05, "replay": 0.08}
COPIED = ["product_id", "category", "page"]
BLOCK = 1000


def _block(order: str) -> Column:
    return F.floor(F.col(order) / BLOCK)


def sequence_faults(events: DataFrame, mode: str = "xxhash", rates: dict[str, float] | None = None) -> DataFrame:
    """Impossible types, repeats, backtracking and replays on the events picked by ``__sel_wrong_event_sequence``.

    ``events`` hold event_id, session_id, event_order (1, 2, ... in the
    session), event_type, event_timestamp, product_id, category and page.  An
    event gets at most one inserted row: a repeat of the previous event 1 to 10
    seconds later, else itself on the page of a drawn event of the session,
    else itself on that of a drawn product view.  Inserted rows have the id
    -(event_id + 1) and only their own label.
    """
    rate = {**RATES, **(rates or {})}
    on = F.col("__sel_wrong_event_sequence")
    keep = ["event_id", "session_id", "event_order", "event_type", "event_timestamp", *COPIED]
    e = events.select(*keep, on.alias("__on"))
    views = F.when(F.col("event_type") == "Product View", 1).otherwise(0)
    sizes = e.groupBy("session_id").agg(F.count(F.lit(1)).alias("__n"), F.sum(views).alias("__n_views"))
    hits = (e.where("__on").join(sizes, "session_id")
            .withColumn("__impossible", u(100, mode) < rate["impossible"])
            .withColumn("__kind", F.when((F.col("event_order") > 1) & (u(102, mode) < rate["repeat"]), "repeat")
                        .when(u(103, mode) < rate["backtrack"], "backtrack")
                        .when((F.col("__n_views") > 0) & (u(104, mode) < rate["replay"]), "replay"))
            .withColumn("__pick", F.when(F.col("__kind") == "repeat", F.col("event_order") - 1)
                        .when(F.col("__kind") == "backtrack", 1 + F.floor(u(106, mode) * F.col("__n")))
                        .when(F.col("__kind") == "replay", 1 + F.floor(u(107, mode) * F.col("__n_views"))).cast("long")))
    # positions of all events, and of the product views among them
    old = e.select("session_id", F.col("event_order").alias("__pick"), F.col("event_type").alias("__old_type"),
                   *[F.col(c).alias(f"__old_{c}") for c in COPIED], F.lit(False).alias("__view"))
    seen = running_sum(e.where(F.col("event_type") == "Product View").withColumn("__one", F.lit(1)), ["session_id"], ["event_order"],
                       "__one", "__pick", bucket=_block("event_order"))
    old = old.unionByName(seen.select("session_id", F.col("__pick").cast("long").alias("__pick"), F.col("event_type").alias("__old_type"),
                                      *[F.col(c).alias(f"__old_{c}") for c in COPIED], F.lit(True).alias("__view")))
    drawn = hits.where(F.col("__kind").isNotNull()).withColumn("__view", F.col("__kind") == "replay")
    repeat = F.col("__kind") == "repeat"
    label = F.when(repeat, "event repeat").when(F.col("__kind") == "backtrack", "random backtracking").otherwise("replay event")
    later = F.make_interval(secs=(1 + F.floor(u(105, mode) * 10)).cast("int"))
    new = drawn.join(old, ["session_id", "__pick", "__view"]).select(
        (-(F.col("event_id") + 1)).alias("event_id"), "session_id", "event_order",
        F.when(repeat, F.col("__old_type")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(repeat, F.col("event_timestamp") + later).otherwise(F.col("event_timestamp")).alias("event_timestamp"),
        *[F.col(f"__old_{c}").alias(c) for c in COPIED], F.array(label).alias(ERR), F.lit(1).alias("__inserted"))
    wrong = hits.where("__impossible").select("event_id", F.element_at(
        F.array(*[F.lit(x) for x in IMPOSSIBLE_EVENTS]), (F.floor(u(101, mode) * len(IMPOSSIBLE_EVENTS)) + 1).cast("int")).alias("__wrong"))
    none = F.array().cast("array<string>")
    base = e.join(wrong, "event_id", "left").select(
        "event_id", "session_id", "event_order", F.coalesce("__wrong", "event_type").alias("event_type"), "event_timestamp", *COPIED,
        F.when(F.col("__wrong").isNotNull(), F.array(F.lit("impossible event sequence"))).otherwise(none).alias(ERR), F.lit(0).alias("__inserted"))
    both = base.unionByName(new).withColumn("__old_order", F.col("event_order")).withColumn("__one", F.lit(1)).drop("event_order")
    ordered = running_sum(both, ["session_id"], ["__old_order", "__inserted"], "__one", "event_order", bucket=_block("__old_order"))
    return ordered.select(*keep, ERR).withColumn("event_order", F.col("event_order").cast("long"))


def burst_sessions(rows: DataFrame, within_s: int = 120, at_least: int = 4) -> DataFrame:
    """Sessions with ``at_least`` events inside ``within_s`` seconds.

    Events are counted by a RANGE frame inside (session, hour); the last
    events of an hour are copied to the next one, where they are counted but
    not judged, so a session of any length is many small windows.
    """
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("event_timestamp"))
    hour = 3_600_000
    e = rows.where(F.col("event_timestamp").isNotNull() & F.col("session_id").isNotNull()).select("session_id", ms.alias("__ms"))
    e = e.select("session_id", "__ms", F.floor(F.col("__ms") / hour).alias("__hour"))
    guests = e.where(F.pmod("__ms", F.lit(hour)) >= hour - within_s * 1000).select("session_id", "__ms", (F.col("__hour") + 1).alias("__hour"), F.lit(True).alias("__guest"))
    w = Window.partitionBy("session_id", "__hour").orderBy("__ms").rangeBetween(-within_s * 1000, 0)
    n = e.withColumn("__guest", F.lit(False)).unionByName(guests).select("session_id", "__guest", F.count(F.lit(1)).over(w).alias("__n"))
    return n.where(~F.col("__guest") & (F.col("__n") >= at_least)).select("session_id").distinct()


def detect_sessions(rows: DataFrame, repeat_s: int = 3, orphan_events: int = 3, orphan_span_s: int = 3600) -> DataFrame:
    """T12 detector: ``rows`` (row_id, session_id, event_timestamp, event_type, product_id, page) with ``detected``.

    * duplicate event: the same session, type, product and page at most
      ``repeat_s`` seconds before;
    * bot traffic: every event of a session with a burst;
    * orphan session: at least ``orphan_events`` events in at most
      ``orphan_span_s`` seconds, without a landing on the home page, without an
      outcome of a payment and without a burst.
    """
    like = ["session_id", "event_type", "product_id", "page"]
    d = neighbour(rows, like, ["event_timestamp", "row_id"], ["event_timestamp"], "prev", bucket=F.date_trunc("hour", F.col("event_timestamp")))
    gap = F.timestamp_diff("MILLISECOND", F.col("prev_event_timestamp"), F.col("event_timestamp"))
    burst = burst_sessions(rows).withColumn("__burst", F.lit(True))
    whole = rows.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("__n"), F.timestamp_diff("SECOND", F.min("event_timestamp"), F.max("event_timestamp")).alias("__span"),
        F.bool_or(F.col("event_type") == "Home View").alias("__home"),
        F.bool_or(F.col("event_type").isin("Payment Successful", "Payment Failed")).alias("__paid"))
    stray = whole.where((F.col("__n") >= orphan_events) & (F.col("__span") <= orphan_span_s) & ~F.col("__home") & ~F.col("__paid")) \
        .select("session_id", F.lit(True).alias("__stray"))
    j = d.join(burst, "session_id", "left").join(stray, "session_id", "left")
    is_burst = F.coalesce("__burst", F.lit(False))
    found = F.array_compact(F.array(
        F.when(F.coalesce(gap <= repeat_s * 1000, F.lit(False)), F.lit("duplicate event")),
        F.when(is_burst, F.lit("bot traffic")), F.when(F.coalesce("__stray", F.lit(False)) & ~is_burst, F.lit("orphan session"))))
    return j.select(*rows.columns, found.alias("detected"))


def detector_quality(detected: DataFrame, injected: str = ERR) -> DataFrame:
    """Per label: rows it was injected in, rows it was found in, both, recall and precision (null without rows)."""
    x = detected.select(F.explode(F.array_union(injected, "detected")).alias("label"), F.col(injected).alias("__i"), "detected")
    inj, det = F.array_contains("__i", F.col("label")), F.array_contains("detected", F.col("label"))
    n = x.groupBy("label").agg(F.count_if(inj).alias("injected"), F.count_if(det).alias("detected"), F.count_if(inj & det).alias("both"))
    return n.select("*", F.round(F.try_divide("both", "injected"), 6).alias("recall"), F.round(F.try_divide("both", "detected"), 6).alias("precision"))
