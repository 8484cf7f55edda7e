"""Price and stock arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["pack_discount_factor", "list_price", "min_spend", "promotion_value",
           "stock_band", "stock_status", "price_deviation", "competitor_price",
           "STOCK_BANDS", "STOCK_STATUSES"]


def _between(lo: float, hi: float, frac: float) -> float:
    return lo + (hi - lo) * frac


def pack_discount_factor(pack_qty: Column, frac: float = 0.5) -> Column:
    """bulk factor range by units (<=2, <=6, <=12, more); the draw is a
    fixed point ``frac`` inside the range.  A null pack gives 1.0."""
    return (F.when(pack_qty.isNull(), F.lit(1.0))
            .when(pack_qty <= 2, F.lit(_between(0.9, 1.0, frac)))
            .when(pack_qty <= 6, F.lit(_between(0.75, 0.9, frac)))
            .when(pack_qty <= 12, F.lit(_between(0.6, 0.8, frac)))
            .otherwise(F.lit(_between(0.5, 0.7, frac))))


def list_price(base: Column, net_value: Column, units: Column, factor: Column,
               category_min: Column | None = None, cap_min: Column | None = None,
               cap_max: Column | None = None, margin: Column | float = 0.725,
               cap_frac: float = 0.5) -> Column:
    """struct(price, cost).

    price = base x (net/100, or 1) x units x factor, floored at 0.4 x base x
    units and at the category minimum; a per-unit pack cap pulls the unit
    price into [cap_min, cap_max] for multi-packs; the upper cap is
    base x net x units x 0.85 + 5; cost = price x margin, at most 0.95 x
    price.  Both rounded to cents.
    """
    netmul = F.coalesce(net_value / 100, F.lit(1.0))
    p = base * netmul * units * factor
    p = F.greatest(p, base * units * 0.4)
    if category_min is not None:
        p = F.greatest(p, F.coalesce(category_min, F.lit(0.0)))
    if cap_min is not None and cap_max is not None:
        unit = p / units
        unit = (F.when(cap_max.isNull() | (units <= 1), unit)
                .when(unit > cap_max, cap_max * _between(0.85, 1.0, cap_frac))
                .when(unit < cap_min, cap_min * _between(1.0, 1.15, cap_frac))
                .otherwise(unit))
        p = unit * units
    p = F.least(p, base * netmul * units * 0.85 + 5)
    # money is rounded in decimal (HALF_UP) after the float arithmetic, so
    # a half cent rounds the same way on every engine
    pd = p.cast("decimal(38,8)")
    m = margin.cast("decimal(10,6)") if isinstance(margin, Column) else F.lit(Decimal(str(margin)))
    cost = F.least(pd * m, pd * F.lit(Decimal("0.95")))
    return F.struct(F.round(pd, 2).cast("decimal(18,2)").alias("price"),
                    F.round(cost, 2).cast("decimal(18,2)").alias("cost"))


def min_spend(mechanic: Column, scope: Column, value: Column, category_base: Column | None = None,
              free_shipping_min: Column | None = None, multiplier: float = 2.0) -> Column:
    """free shipping -> campaign minimum (default 80); category +
    percentage -> null; category + dollar -> max(base, value x k); else null."""
    base = F.coalesce(category_base, F.lit(0.0)) if category_base is not None else F.lit(0.0)
    fs = F.coalesce(free_shipping_min, F.lit(80.0)) if free_shipping_min is not None else F.lit(80.0)
    return (F.when(mechanic == "free_shipping", fs.cast("double"))
            .when((scope == "category") & (mechanic == "dollar_discount"),
                  F.greatest(base.cast("double"), value.cast("double") * multiplier)))


def promotion_value(mechanic: Column, scope: Column, pct_base: Column, campaign_type: Column,
                    product_price: Column, category_max_price: Column, category_cap: Column | None = None,
                    bundle_discount: Column | None = None, product_share: float = 0.2,
                    dollar_frac: float = 0.5) -> Column:
    """F16: promotion value by mechanic.

    percentage: base (+10 for Clearance, x0.7 without a campaign), at most 40,
    rounded; dollar on a product: share of its price; dollar elsewhere: a
    point between 2 and min(category cap, 0.4 x max price in the category);
    free shipping 0; bundle: the bundle's discount.
    """
    pct = pct_base + F.when(campaign_type == "Clearance", 10).otherwise(0)
    pct = F.when(campaign_type.isNull(), pct * 0.7).otherwise(pct)
    cap = F.coalesce(category_cap, category_max_price * 0.3) if category_cap is not None else category_max_price * 0.3
    hi = F.least(cap, category_max_price * 0.4)
    other = F.when(category_max_price.isNull(), F.lit(6.0)).otherwise(2 + (hi - 2) * dollar_frac)
    return (F.when(mechanic == "percentage_discount", F.round(F.least(pct, F.lit(40)), 0))
            .when((mechanic == "dollar_discount") & (scope == "product"), F.round(product_price * product_share, 2))
            .when(mechanic == "dollar_discount", F.round(other, 2))
            .when(mechanic == "free_shipping", F.lit(0.0))
            .when(mechanic == "bundle", F.round(bundle_discount, 2) if bundle_discount is not None else F.lit(None)))


# Stock bands (inclusive bounds) and their status labels.
STOCK_BANDS = [("0", 0, 0), ("1-5", 1, 5), ("6-20", 6, 20), ("21-100", 21, 100), ("101+", 101, 10000000)]
STOCK_STATUSES = {"0": "Out of Stock", "1-5": "Limited Stock", "6-20": "Low Stock",
                  "21-100": "In Stock", "101+": "Overstocked"}


def stock_band(qty: Column) -> Column:
    """first band whose closed range holds qty, else 'Overstocked'."""
    expr = None
    for name, lo, hi in STOCK_BANDS:
        cond = qty.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("Overstocked")


def stock_status(band: Column) -> Column:
    """band -> status label; unknown band -> ''."""
    m = F.create_map(*[F.lit(x) for kv in STOCK_STATUSES.items() for x in kv])
    return F.coalesce(F.element_at(m, band), F.lit(""))


def price_deviation(store_price: Column, master_price: Column, tolerance: float = 0.15) -> Column:
    """struct(ratio, flagged): store / master and |ratio - 1| > tol."""
    ratio = F.try_divide(store_price.cast("double"), master_price.cast("double"))
    return F.struct(F.round(ratio, 4).alias("ratio"),
                    (F.abs(ratio - 1) > tolerance).alias("flagged"))


def competitor_price(price: Column, bias: Column | float = 0.0, noise: float = 0.0,
                     tier_frac: float = 0.5) -> Column:
    """price x (1 + bias + noise) + absolute tier noise (a point in the
    tier range: <2, <10, <50, rest), floored at 0.5 x price, rounded."""
    def dec(x: float) -> Column:  # exact literals keep decimal input in decimal
        return F.lit(Decimal(str(round(x, 6))))
    b = bias if isinstance(bias, Column) else dec(bias)
    absn = (F.when(price < 2, dec(_between(-0.3, 0.5, tier_frac)))
            .when(price < 10, dec(_between(-1.0, 1.5, tier_frac)))
            .when(price < 50, dec(_between(-3, 5, tier_frac)))
            .otherwise(dec(_between(-10, 20, tier_frac))))
    p = price * (dec(1.0) + b + dec(noise)) + absn
    return F.round(F.greatest(p, price * dec(0.5)), 2).cast("decimal(18,2)")
