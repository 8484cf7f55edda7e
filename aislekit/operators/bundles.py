"""Bundle pricing, windows and phases (U01-U06).  Money in decimal."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MONEY = "decimal(18,2)"
# Phase rules.
MIN_PHASE_DAYS = 14
MIN_WINDOW_FOR_SPLIT = MIN_PHASE_DAYS * 2
MAX_DISCOUNT_PCT = {"LAUNCH": 0.25, "PROMO": 0.30, "EOL": 0.33}
PHASE_STEP = {"PROMO": 0.05, "EOL": 0.03}
BUNDLE_TYPES = ["Buy One, Get One", "Set", "2 For X", "Buy N Save X"]


def D(x) -> Column:
    return F.lit(Decimal(str(x)))


def money(c: Column) -> Column:
    return F.round(c.cast("decimal(38,6)"), 2).cast(MONEY)


def bundle_totals(members: DataFrame, products: DataFrame) -> DataFrame:
    """Sum of member price x quantity and cost x quantity per bundle."""
    p = products.select("product_id", "selling_price", "cost_price")
    return members.join(p, "product_id").groupBy("bundle_id").agg(
        F.sum(F.col("selling_price") * F.col("quantity")).alias("total_price"),
        F.sum(F.col("cost_price") * F.col("quantity")).alias("total_cost"))


def bundle_price(bundle_type: Column, total: Column, cost: Column, set_mult: float = 0.9, two_for_mult: float = 0.85,
                 buy_n_share: float = 0.2) -> Column:
    """struct(bundle_price, discount_value): BOGO half price, Set and
    2-For a multiplier, Buy-N minus a share; never below cost; an unknown
    type fails the job."""
    p = (F.when(bundle_type == "Buy One, Get One", F.greatest(total / 2, cost))
         .when(bundle_type == "Set", F.greatest(total * D(set_mult), cost))
         .when(bundle_type == "2 For X", F.greatest(total * D(two_for_mult), cost))
         .when(bundle_type == "Buy N Save X", F.greatest(total - total * D(buy_n_share), cost))
         .otherwise(F.raise_error(F.concat(F.lit("Unknown bundle type: "), bundle_type))))
    return F.struct(money(p).alias("bundle_price"), money(total - p).alias("discount_value"))


def price_guards(price: Column, discount: Column, cost: Column) -> Column:
    """Price <= 0 -> cost x 1.01; discount >= price -> 0.49 x price;
    discount never negative."""
    p = F.when(price <= 0, money(cost * D(1.01))).otherwise(price)
    d = F.when(discount >= p, money(p * D(0.49))).otherwise(discount)
    return F.struct(p.alias("bundle_price"), F.greatest(d, D(0).cast(MONEY)).alias("discount_value"))


def bundle_window(members: DataFrame, launches: DataFrame, data_start: str, data_end: str, max_days: int = 120) -> DataFrame:
    """Window where every member is on sale: latest launch to earliest
    discontinuation (data window when unknown), at most ``max_days`` long;
    null when the members never overlap."""
    j = members.join(launches, "product_id", "left")
    w = j.groupBy("bundle_id").agg(F.max("launch_date").alias("__l"), F.min("discontinuation_date").alias("__d"))
    s = F.coalesce(F.col("__l"), F.lit(data_start).cast("date"))
    e = F.least(F.date_add(s, max_days), F.coalesce(F.col("__d"), F.lit(data_end).cast("date")), F.lit(data_end).cast("date"))
    bad = F.col("__l").isNotNull() & F.col("__d").isNotNull() & (F.col("__l") > F.col("__d"))
    return w.select("bundle_id", F.when(~bad, s).alias("window_start"), F.when(~bad, e).alias("window_end"))


def split_window(start: Column, end: Column, with_promo: Column, launch_frac: float = 0.4, promo_frac: float = 0.425) -> Column:
    """LAUNCH, optional PROMO, EOL phases (array<struct>), each at least
    14 days, contiguous; windows under 28 days stay one LAUNCH phase; a
    remainder under 14 days extends the last phase."""
    ph = lambda s, e, n: F.struct(s.alias("phase_start"), e.alias("phase_end"), F.lit(n).alias("pricing_phase"))
    total = F.datediff(end, start)
    launch_days = F.greatest(F.lit(MIN_PHASE_DAYS), F.floor(total * launch_frac).cast("int"))
    launch_end = F.least(F.date_add(start, launch_days - 1), end)
    rs = F.date_add(launch_end, 1)
    rem = F.datediff(end, rs)
    promo = with_promo & (rem >= MIN_PHASE_DAYS * 2)
    promo_days = F.greatest(F.lit(MIN_PHASE_DAYS), F.floor(rem * promo_frac).cast("int"))
    promo_end = F.least(F.date_add(rs, promo_days - 1), end)
    rs2 = F.date_add(promo_end, 1)
    rem2 = F.datediff(end, rs2)
    no_promo = (F.when(rem >= MIN_PHASE_DAYS, F.array(ph(start, launch_end, "LAUNCH"), ph(rs, end, "EOL")))
                .otherwise(F.array(ph(start, end, "LAUNCH"))))
    with_p = (F.when(rs2 > end, F.array(ph(start, launch_end, "LAUNCH"), ph(rs, promo_end, "PROMO")))
              .when(rem2 >= MIN_PHASE_DAYS, F.array(ph(start, launch_end, "LAUNCH"), ph(rs, promo_end, "PROMO"), ph(rs2, end, "EOL")))
              .otherwise(F.array(ph(start, launch_end, "LAUNCH"), ph(rs, end, "PROMO"))))
    return (F.when(start > end, F.array(ph(start, start, "LAUNCH")))
            .when(total < MIN_WINDOW_FOR_SPLIT, F.array(ph(start, end, "LAUNCH")))
            .when(rs > end, F.array(ph(start, launch_end, "LAUNCH")))
            .when(promo, with_p).otherwise(no_promo))


def phase_prices(base_price: Column, base_discount: Column, phases: Column, step_frac: float = 0.5) -> Column:
    """Price per phase: the discount share starts at the base share,
    steps up by at most 5 points (PROMO) / 3 points (EOL) from the previous
    phase, capped at 30% / 33%; guards as U02.  A fold over the phases."""
    retail = base_price + base_discount
    pct0 = F.try_divide(base_discount, retail).cast("double")
    init = F.struct(pct0.alias("pct"), F.array().cast("array<struct<pricing_phase:string,pct:double>>").alias("out"))

    def step(acc, p):
        name = p["pricing_phase"]
        nxt = (F.when(name == "LAUNCH", acc["pct"])
               .when(name == "PROMO", F.least(acc["pct"] + PHASE_STEP["PROMO"] * step_frac, F.lit(MAX_DISCOUNT_PCT["PROMO"])))
               .otherwise(F.least(acc["pct"] + PHASE_STEP["EOL"] * step_frac, F.lit(MAX_DISCOUNT_PCT["EOL"]))))
        return F.struct(nxt.alias("pct"), F.concat(acc["out"], F.array(F.struct(name.alias("pricing_phase"), nxt.alias("pct")))).alias("out"))

    return F.aggregate(phases, init, step)["out"]
