"""Slowly changing history and product content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislekit.operators.sequence import neighbour

# Allowed status chain and dwell days per status.
STATUS_CHAIN = {
    "New": ["Active", "Discontinued"],
    "Active": ["Seasonal", "Phasing Out"],
    "Seasonal": ["Active", "Phasing Out"],
    "Phasing Out": ["Discontinued"],
    "Discontinued": [],
}
STATUS_DWELL_DAYS = {
    "New": (14, 120),
    "Active": (120, 1095),
    "Seasonal": (60, 180),
    "Phasing Out": (30, 180),
    "Discontinued": (365, 3650),
}
# Content tiers in order.
QUALITY_TIERS = ["Poor", "Average", "Good", "Excellent"]


def scd2(changes: DataFrame, key: str = "product_id", ts: str = "changed_on", attr: str = "status") -> DataFrame:
    """D01 (+D05): status changes -> SCD2 versions.

    Consecutive rows with the same status are one version; valid_from is
    the change date, valid_to the next version's start (null for the
    last), is_current marks the open version, launch_date is the first
    start, and discontinuation_date is set only on Discontinued rows.
    """
    ordered = [ts, attr]
    n = neighbour(changes.select(key, ts, attr), [key], ordered, [attr], "prev")
    versions = n.where(~F.col(attr).eqNullSafe(F.col(f"prev_{attr}"))).drop(f"prev_{attr}")
    nx = neighbour(versions, [key], ordered, [ts], "next")
    launch = versions.groupBy(key).agg(F.min(ts).alias("launch_date"))
    out = nx.join(launch, key).select(
        key, attr, "launch_date",
        F.when(F.col(attr) == "Discontinued", F.col(ts)).alias("discontinuation_date"),
        F.col(ts).alias("valid_from"), F.col(f"next_{ts}").alias("valid_to"),
        F.col(f"next_{ts}").isNull().alias("is_current"))
    return out


def current_version(versions: DataFrame, key: str = "product_id") -> DataFrame:
    """One row per key: the current version, else the latest one
    (grouped max over (is_current, valid_from), no window)."""
    cols = [c for c in versions.columns if c != key]
    best = versions.groupBy(key).agg(F.max(F.struct(F.col("is_current").alias("__c"), F.col("valid_from").alias("__v"),
                                                    *[F.col(c) for c in cols])).alias("__b"))
    return best.select(key, *[F.col(f"__b.{c}").alias(c) for c in cols])


def status_transitions(versions: DataFrame, key: str = "product_id") -> DataFrame:
    """Observed (from, to) status pairs with counts and whether the
    allowed chain permits them."""
    n = neighbour(versions.select(key, "valid_from", "status"), [key], ["valid_from", "status"], ["status"], "next")
    pairs = n.where(F.col("next_status").isNotNull()).groupBy(F.col("status").alias("from_status"),
                                                             F.col("next_status").alias("to_status")).count()
    allowed = F.create_map(*[x for k, v in STATUS_CHAIN.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]) if v else F.array().cast("array<string>"))])
    return pairs.select("from_status", "to_status", F.col("count").alias("n"),
                        F.coalesce(F.array_contains(F.element_at(allowed, F.col("from_status")), F.col("to_status")),
                                   F.lit(False)).alias("allowed"))


def dwell_days(versions: DataFrame) -> DataFrame:
    """Days in each closed version against the status's (min, max)."""
    lo = F.create_map(*[x for k, (a, b) in STATUS_DWELL_DAYS.items() for x in (F.lit(k), F.lit(a))])
    hi = F.create_map(*[x for k, (a, b) in STATUS_DWELL_DAYS.items() for x in (F.lit(k), F.lit(b))])
    d = F.datediff(F.col("valid_to"), F.col("valid_from"))
    return versions.where(F.col("valid_to").isNotNull()).select(
        "product_id", "status", "valid_from", d.alias("dwell_days"),
        d.between(F.element_at(lo, F.col("status")), F.element_at(hi, F.col("status"))).alias("within_bounds"))


# Lower bounds of each tier's content ranges
# (images, image score, description length); Excellent also has no
# missing attributes.
TIER_FLOORS = [("Excellent", 5, 0.9, 250), ("Good", 3, 0.7, 120), ("Average", 1, 0.4, 50)]


def content_tier(image_count: Column, score: Column, description_length: Column, missing: Column) -> Column:
    """The best tier whose lower bounds the row meets, else Poor."""
    expr = None
    for tier, img, sc, desc in TIER_FLOORS:
        cond = (image_count >= img) & (score >= sc) & (description_length >= desc)
        if tier == "Excellent":
            cond = cond & (F.coalesce(missing, F.lit(0)) == 0)
        expr = F.when(cond, tier) if expr is None else expr.when(cond, tier)
    return expr.otherwise("Poor")


def tier_steps(versions: DataFrame, key: str = "product_id") -> DataFrame:
    """Versions whose tier moves more than one step from the previous
    version of the product -> (key, valid_from, prev tier, tier, gap days)."""
    idx = F.array_position(F.array(*[F.lit(t) for t in QUALITY_TIERS]), F.col("quality_tier"))
    d = versions.select(key, "valid_from", "content_version_id", "quality_tier", idx.alias("tier_index"))
    n = neighbour(d, [key], ["valid_from", "content_version_id"], ["tier_index", "valid_from"], "prev")
    return n.where(F.col("prev_tier_index").isNotNull()).select(
        key, "content_version_id", "valid_from", "tier_index", "prev_tier_index",
        F.datediff("valid_from", "prev_valid_from").alias("gap_days"),
        (F.abs(F.col("tier_index") - F.col("prev_tier_index")) <= 1).alias("one_step"))


def review_delay(purchase: Column, review: Column) -> Column:
    """Days from purchase to review, and whether within 0..14."""
    d = F.datediff(F.to_date(review), F.to_date(purchase))
    return F.struct(d.alias("delay_days"), d.between(0, 14).alias("within_window"))


def age_at(dob: Column, when: Column) -> Column:
    """Completed years between birth and the date (birthday rule)."""
    w, d = F.to_date(when), F.to_date(dob)
    before = (F.month(w) < F.month(d)) | ((F.month(w) == F.month(d)) & (F.dayofmonth(w) < F.dayofmonth(d)))
    return (F.year(w) - F.year(d) - F.when(before, 1).otherwise(0)).cast("int")


def competitor_price_history(scrapes: DataFrame, products: DataFrame, promo_ratio: float = 0.9) -> DataFrame:
    """Per (competitor, product, weekly batch) the last scraped price
    (latest update wins, grouped, no window), the promotion flag (price
    under ``promo_ratio`` x own price) and the price index against our own
    price."""
    batch = F.to_date(F.date_trunc("week", F.col("update_timestamp")))
    last = scrapes.groupBy("competitor", "product_id", batch.alias("batch_week")).agg(
        F.max("update_timestamp").alias("update_timestamp"),
        F.max_by("scraped_price", F.struct("update_timestamp", "scraped_price")).alias("scraped_price"))
    own = products.select("product_id", F.col("selling_price").alias("__own"))
    j = last.join(own, "product_id", "left")
    return j.select("competitor", "product_id", "batch_week", "update_timestamp", "scraped_price",
                    (F.col("scraped_price") < F.col("__own") * promo_ratio).alias("has_active_promo"),
                    F.round(F.try_divide(F.col("scraped_price").cast("double"), F.col("__own").cast("double")), 4).alias("price_index"))


# Signup weight per calendar month.
SEASONAL_PEAK_MONTHS = {1: 0.5, 2: 0.6, 3: 0.7, 4: 0.8, 5: 0.9, 6: 1.0, 7: 1.1, 8: 1.2, 9: 1.3, 10: 1.4, 11: 1.8, 12: 2.0}


def monthly_signup_index(customers: DataFrame) -> DataFrame:
    """Observed share of signups per calendar month against the month
    weight's share -> (month, signups, observed_share, expected_share, index)."""
    tot_w = sum(SEASONAL_PEAK_MONTHS.values())
    w = F.create_map(*[x for k, v in SEASONAL_PEAK_MONTHS.items() for x in (F.lit(k), F.lit(v / tot_w))])
    c = customers.where(F.col("signup_date").isNotNull())
    from pyspark.sql import Window
    g = c.groupBy(F.month("signup_date").alias("month")).agg(F.count(F.lit(1)).alias("signups"))
    j = g.withColumn("__n", F.sum("signups").over(Window.partitionBy()))  # 12 grouped rows
    obs = F.col("signups") / F.col("__n")
    exp_ = F.element_at(w, F.col("month"))
    return j.select("month", "signups", F.round(obs, 6).alias("observed_share"), F.round(exp_, 6).alias("expected_share"),
                    F.round(obs / exp_, 4).alias("signup_index"))
