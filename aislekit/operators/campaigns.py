"""Campaign audiences, assignments and exposure funnels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislekit.operators.faults import draw
from aislekit.operators.sequence import running_sum

# Consent column per direct channel; channel groups;
# budget range per channel and multiplier per campaign type.
CHANNEL_CONSENT_MAP = {"Email": "email_marketing_opt_in", "SMS": "sms_marketing_opt_in",
                       "Push Notifications": "push_notifications_opt_in"}
DIRECT_MESSAGE_CHANNELS = ["Email", "SMS", "Push Notifications"]
EXPOSURE_ONLY_CHANNELS = ["Paid Advertisements", "In-App"]
CONTROL_GROUP_PERCENTAGE = 0.5


def audience(customers: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Customers whose segment is the campaign's target and who signed
    up on or before its start (equi join on the segment)."""
    c = customers.alias("c")
    k = campaigns.alias("k")
    return c.join(k, F.col("c.customer_segment") == F.col("k.target_segment")).where(
        F.col("c.signup_date") <= F.col("k.start_date"))


def consent_ok(channels: Column) -> Column:
    """With any direct channel, at least one of those channels' opt-ins
    is true; with none, everyone passes."""
    direct = F.filter(channels, lambda ch: ch.isin(DIRECT_MESSAGE_CHANNELS))
    optin = lambda ch: F.coalesce(reduce(lambda a, b: a.when(ch == b[0], F.col(b[1])),
                                         list(CHANNEL_CONSENT_MAP.items())[1:],
                                         F.when(ch == "Email", F.col("email_marketing_opt_in"))), F.lit(False))
    return F.when(F.size(direct) == 0, F.lit(True)).otherwise(F.exists(direct, optin))


def ab_split(aud: DataFrame, is_ab: Column, min_treatment: int = 50, min_control: int = 50,
             seed: int = 17, mode: str = "xxhash") -> DataFrame:
    """assignment_group per (campaign, customer).  Not A/B ->
    everyone Treatment; audience below the minimum sizes -> nobody; else
    Control where a (campaign, customer) hash draw < the control share.
    The audience size is a grouped count; no rank over a campaign."""
    n = aud.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("__n"))
    a = aud.join(n, "campaign_id")
    key = F.concat_ws("|", F.col("campaign_id").cast("string"), F.col("customer_id").cast("string"))
    u = draw(key, seed, mode)
    grp = F.when(~is_ab, "Treatment").when(u < CONTROL_GROUP_PERCENTAGE, "Control").otherwise("Treatment")
    return (a.where(~is_ab | (F.col("__n") >= min_treatment + min_control))
            .select("*", grp.alias("assignment_group"), F.col("start_date").alias("eligible_at")).drop("__n"))


def audience_channels(assignments: DataFrame, channels: str = "channel_list") -> DataFrame:
    """One row per (assignment, channel)."""
    return assignments.select("*", F.explode(channels).alias("channel"))


def exposure_funnel(exposures: DataFrame) -> DataFrame:
    """Delivered / opened / clicked counts, cost on delivered rows and
    mean minutes exposed->opened and opened->clicked, by channel and group,
    with ``cube`` totals (null = all)."""
    mins = lambda a, b: F.timestamp_diff("MICROSECOND", F.col(a), F.col(b)) / 6e7
    return exposures.cube("channel", "assignment_group").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("exposed")).alias("delivered"),
        F.count_if(F.col("opened")).alias("opened"), F.count_if(F.col("clicked")).alias("clicked"),
        F.sum(F.when(F.col("exposed"), F.col("cost_per_msg"))).alias("cost"),
        F.round(F.avg(mins("exposed_time", "opened_time")), 6).alias("mins_to_open"),
        F.round(F.avg(mins("opened_time", "clicked_time")), 6).alias("mins_to_click"),
        F.grouping_id().alias("grouping"))


def funnel_lift(exposures: DataFrame) -> DataFrame:
    """Per channel, click rate of Treatment minus Control."""
    r = exposures.groupBy("channel").agg(
        F.try_divide(F.count_if(F.col("clicked") & (F.col("assignment_group") == "Treatment")).cast("double"),
                     F.count_if(F.col("assignment_group") == "Treatment")).alias("t_rate"),
        F.try_divide(F.count_if(F.col("clicked") & (F.col("assignment_group") == "Control")).cast("double"),
                     F.count_if(F.col("assignment_group") == "Control")).alias("c_rate"))
    return r.select("channel", F.round("t_rate", 6).alias("treatment_click_rate"), F.round("c_rate", 6).alias("control_click_rate"),
                    F.round(F.col("t_rate") - F.col("c_rate"), 6).alias("lift"))


def channel_mix(channels: Column, n: Column) -> Column:
    """Distinct channels in first-seen order, at most n."""
    return F.slice(F.array_distinct(channels), 1, n)


def exposure_counts(page_promos: DataFrame) -> DataFrame:
    """Times each promotion has been seen so far in the session (and
    per mechanic), as running counts bucketed by hour."""
    d = page_promos.withColumn("__one", F.lit(1))
    b = F.date_trunc("hour", F.col("event_timestamp"))
    d = running_sum(d, ["session_id", "promotion_id"], ["event_timestamp", "event_id"], "__one", "times_seen", bucket=b)
    d = running_sum(d, ["session_id", "promotion_mechanic"], ["event_timestamp", "event_id", "promotion_id"], "__one",
                    "mechanic_seen", bucket=b)
    return d.drop("__one")


# Mechanics each channel supports, and per campaign type the
# primary / secondary mechanics and promotion count range.
CHANNEL_PROMOTION_COMPATIBILITY = {
    "Email": ["free_shipping", "percentage_discount"],
    "Push Notifications": ["free_shipping", "percentage_discount"],
    "Paid Advertisements": ["percentage_discount", "bundle"],
    "In-App": ["bundle", "percentage_discount"],
    "SMS": ["free_shipping"],
}
CAMPAIGN_PROMOTION_STRATEGY = {
    "Seasonal": {"primary": ["percentage_discount", "bundle"], "secondary": ["free_shipping"], "promo_count": (2, 3)},
    "Clearance": {"primary": ["dollar_discount"], "secondary": ["percentage_discount"]},
    "Acquisition": {"primary": ["free_shipping", "percentage_discount"], "secondary": []},
    "Retention": {"primary": ["percentage_discount"], "secondary": ["free_shipping"]},
}
DEFAULT_PROMO_COUNT = (1, 2)  # the types that only declare max_promotions use the default


def mechanics_for(campaign_type: Column, channels: Column, count_draw: Column) -> Column:
    """Mechanics a campaign carries: the channel-allowed mechanics,
    the first allowed primary, then allowed secondaries and unused
    primaries up to the promotion count (drawn in the type's range)."""
    def lit_arr(xs):
        return F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<string>")
    compat = F.create_map(*[x for k, v in CHANNEL_PROMOTION_COMPATIBILITY.items() for x in (F.lit(k), lit_arr(v))])
    allowed = F.array_distinct(F.flatten(F.transform(channels, lambda c: F.coalesce(F.element_at(compat, c), F.array().cast("array<string>")))))

    def pick(field):
        expr = None
        for k, v in CAMPAIGN_PROMOTION_STRATEGY.items():
            val = lit_arr(v[field])
            expr = F.when(campaign_type == k, val) if expr is None else expr.when(campaign_type == k, val)
        return expr.otherwise(F.array().cast("array<string>"))

    lo = F.when(campaign_type == "Seasonal", 2).otherwise(DEFAULT_PROMO_COUNT[0])
    hi = F.when(campaign_type == "Seasonal", 3).otherwise(DEFAULT_PROMO_COUNT[1])
    n = lo + F.floor(count_draw * (hi - lo + 1)).cast("int")
    primary = F.filter(pick("primary"), lambda p: F.array_contains(allowed, p))
    first = F.slice(primary, 1, 1)
    rest = F.concat(F.filter(pick("secondary"), lambda p: F.array_contains(allowed, p)), F.slice(primary, 2, F.greatest(F.size(primary), F.lit(1))))
    fill = F.greatest(n - F.size(first), F.lit(0))
    return F.concat(first, F.slice(rest, 1, fill))
