"""Bundle pricing, windows and phases."""

from __future__ import annotations

from pyspark.sql import functions as F

from aislekit.operators import bundles as U
from aislekit.operators import lookups as J
from aislekit.operators.faults import arith_u_sql, draw
from aislekit.plans.derived import lifecycles
from aislekit.plans.registry import query
from aislekit.plans.sql_common import LIFECYCLES

BT_SQL = "CASE bundle_id % 4 WHEN 0 THEN 'Buy One, Get One' WHEN 1 THEN 'Set' WHEN 2 THEN '2 For X' ELSE 'Buy N Save X' END"


def bundle_type_col():
    return F.element_at(F.array(*[F.lit(x) for x in U.BUNDLE_TYPES]), (F.col("bundle_id") % 4 + 1).cast("int"))


def _totals(t):
    tot = U.bundle_totals(t.view("bundle_items"), t.view("products"))
    return tot.withColumn("bundle_type", bundle_type_col())


TOT_SQL = f"""SELECT bi.bundle_id, {BT_SQL.replace('bundle_id', 'bi.bundle_id')} AS bundle_type, sum(p.selling_price * bi.quantity) AS total_price,
  sum(p.cost_price * bi.quantity) AS total_cost FROM bundle_items bi JOIN products p USING (product_id) GROUP BY 1, 2"""
PRICE_SQL = """CASE bundle_type WHEN 'Buy One, Get One' THEN greatest(total_price / 2, total_cost) WHEN 'Set' THEN greatest(total_price * 0.9, total_cost)
  WHEN '2 For X' THEN greatest(total_price * 0.85, total_cost) ELSE greatest(total_price - total_price * 0.2, total_cost) END"""


def _m(e: str) -> str:
    return f"CAST(round(CAST({e} AS DECIMAL(38,6)), 2) AS DECIMAL(18,2))"


@query("u01_bundle_price", ("bundle_items", "products"), f"""
SELECT bundle_id, bundle_type, {_m(PRICE_SQL)} AS bundle_price, {_m('total_price - (' + PRICE_SQL + ')')} AS discount_value FROM ({TOT_SQL})""")
def u01(t):
    """Bundle price and discount by bundle type, never below cost."""
    d = _totals(t)
    p = U.bundle_price(F.col("bundle_type"), F.col("total_price"), F.col("total_cost"))
    return d.select("bundle_id", "bundle_type", p["bundle_price"].alias("bundle_price"), p["discount_value"].alias("discount_value"))


@query("u02_price_guards", ("bundle_pricings", "products"), f"""
SELECT bundle_pricing_id, CASE WHEN bp <= 0 THEN {_m('cost * 1.01')} ELSE bp END AS bundle_price,
  greatest(CASE WHEN dv >= (CASE WHEN bp <= 0 THEN {_m('cost * 1.01')} ELSE bp END) THEN {_m('(CASE WHEN bp <= 0 THEN ' + _m('cost * 1.01') + ' ELSE bp END) * 0.49')} ELSE dv END,
    CAST(0 AS DECIMAL(18,2))) AS discount_value
FROM (SELECT b.bundle_pricing_id, CAST(b.bundle_price - 900 AS DECIMAL(18,2)) AS bp, b.discount_value AS dv, p.cost_price AS cost
      FROM bundle_pricings b JOIN products p ON p.product_id = b.bundle_id)""")
def u02(t):
    """Price guards on shifted pricing rows (price - 900, so some are <= 0)."""
    b = t.view("bundle_pricings").join(t.view("products").select(F.col("product_id").alias("bundle_id"), "cost_price"), "bundle_id")
    g = U.price_guards((F.col("bundle_price") - 900).cast("decimal(18,2)"), F.col("discount_value"), F.col("cost_price"))
    return b.select("bundle_pricing_id", g["bundle_price"].alias("bundle_price"), g["discount_value"].alias("discount_value"))


WIN_SQL = f"""
WITH pl AS ({LIFECYCLES}),
lk AS (SELECT product_id, arg_max_null(launch_date, row(valid_from, is_current, status)) AS launch_date, arg_max_null(discontinuation_date, row(valid_from, is_current, status)) AS discontinuation_date FROM pl GROUP BY 1),
w AS (SELECT bi.bundle_id, max(lk.launch_date) AS l, min(lk.discontinuation_date) AS d FROM bundle_items bi LEFT JOIN lk USING (product_id) GROUP BY 1)
SELECT bundle_id, CASE WHEN NOT (l IS NOT NULL AND d IS NOT NULL AND l > d) THEN coalesce(l, DATE '1995-01-01') END AS window_start,
  CASE WHEN NOT (l IS NOT NULL AND d IS NOT NULL AND l > d) THEN least(CAST(coalesce(l, DATE '1995-01-01') + INTERVAL 120 DAY AS DATE),
    coalesce(d, DATE '2001-12-31'), DATE '2001-12-31') END AS window_end FROM w"""


def _windows(t):
    return U.bundle_window(t.view("bundle_items"), J.launch_lookup(lifecycles(t)), "1995-01-01", "2001-12-31")


@query("u03_bundle_window", ("bundle_items", "lifecycle_changes"), WIN_SQL)
def u03(t):
    """Window in which every member of a bundle is on sale (max 120 days)."""
    return _windows(t)


_U = "(" + arith_u_sql("bundle_id", 29) + ")"


def _split_sql() -> str:
    def ph(s, e, n):
        return f"{{'phase_start': {s}, 'phase_end': {e}, 'pricing_phase': '{n}'}}"
    le = "least(CAST(s + (greatest(14, CAST(floor(datediff('day', s, e) * 0.4) AS INTEGER)) - 1) * INTERVAL 1 DAY AS DATE), e)"
    rs = f"CAST({le} + INTERVAL 1 DAY AS DATE)"
    rem = f"datediff('day', {rs}, e)"
    pe = f"least(CAST({rs} + (greatest(14, CAST(floor({rem} * 0.425) AS INTEGER)) - 1) * INTERVAL 1 DAY AS DATE), e)"
    rs2 = f"CAST({pe} + INTERVAL 1 DAY AS DATE)"
    rem2 = f"datediff('day', {rs2}, e)"
    return f"""CASE WHEN s > e THEN [{ph('s', 's', 'LAUNCH')}] WHEN datediff('day', s, e) < 28 THEN [{ph('s', 'e', 'LAUNCH')}]
  WHEN {rs} > e THEN [{ph('s', le, 'LAUNCH')}]
  WHEN {_U} < 0.6 AND {rem} >= 28 THEN CASE WHEN {rs2} > e THEN [{ph('s', le, 'LAUNCH')}, {ph(rs, pe, 'PROMO')}]
    WHEN {rem2} >= 14 THEN [{ph('s', le, 'LAUNCH')}, {ph(rs, pe, 'PROMO')}, {ph(rs2, 'e', 'EOL')}]
    ELSE [{ph('s', le, 'LAUNCH')}, {ph(rs, 'e', 'PROMO')}] END
  WHEN {rem} >= 14 THEN [{ph('s', le, 'LAUNCH')}, {ph(rs, 'e', 'EOL')}] ELSE [{ph('s', 'e', 'LAUNCH')}] END"""


SPLIT_SQL = f"""SELECT bundle_id, unnest({_split_sql()}, recursive := true) FROM (
  SELECT bundle_id, window_start AS s, CAST(window_start + INTERVAL 400 DAY AS DATE) AS e FROM ({WIN_SQL}) WHERE window_start IS NOT NULL)"""


def _phases(t):
    w = _windows(t).where(F.col("window_start").isNotNull())
    e = F.date_add("window_start", 400)
    promo = draw(F.col("bundle_id"), 29, "arith") < 0.6
    return w.select("bundle_id", F.explode(U.split_window(F.col("window_start"), e, promo)).alias("p")).select("bundle_id", "p.*")


@query("u04_split_window", ("bundle_items", "lifecycle_changes"), SPLIT_SQL)
def u04(t):
    """LAUNCH / PROMO / EOL phases of a 400-day window from each bundle start."""
    return _phases(t)


@query("u05_phase_prices", ("bundle_items", "products", "lifecycle_changes"), f"""
WITH ph AS ({SPLIT_SQL}), pr AS (SELECT bundle_id, {_m(PRICE_SQL)} AS bp, {_m('total_price - (' + PRICE_SQL + ')')} AS bd FROM ({TOT_SQL})),
j AS (SELECT ph.*, pr.bp, pr.bd, CAST(pr.bd AS DOUBLE) / CAST(pr.bp + pr.bd AS DOUBLE) AS p0 FROM ph JOIN pr USING (bundle_id)),
k AS (SELECT *, CASE pricing_phase WHEN 'LAUNCH' THEN 0 WHEN 'PROMO' THEN 1 ELSE 2 END AS o FROM j),
s AS (SELECT *, CASE WHEN pricing_phase = 'LAUNCH' THEN p0
   WHEN pricing_phase = 'PROMO' THEN least(p0 + 0.025, 0.30)
   ELSE least(CASE WHEN bool_or(pricing_phase = 'PROMO') OVER (PARTITION BY bundle_id) THEN least(p0 + 0.025, 0.30) ELSE p0 END + 0.015, 0.33) END AS pct FROM k)
SELECT bundle_id, pricing_phase, round(pct, 6) AS discount_pct FROM s""")
def u05(t):
    """Discount share per pricing phase, stepping up within caps."""
    pr = _totals(t)
    p = U.bundle_price(F.col("bundle_type"), F.col("total_price"), F.col("total_cost"))
    pr = pr.select("bundle_id", p["bundle_price"].alias("bp"), p["discount_value"].alias("bd"))
    ph = _phases(t).groupBy("bundle_id").agg(F.sort_array(F.collect_list(F.struct("phase_start", "pricing_phase"))).alias("__p"))  # <= 3
    j = ph.join(pr, "bundle_id")
    out = j.select("bundle_id", F.explode(U.phase_prices(F.col("bp"), F.col("bd"), F.col("__p"))).alias("x"))
    return out.select("bundle_id", "x.pricing_phase", F.round("x.pct", 6).alias("discount_pct"))


BUNDLES_SQL = f"""SELECT bi.bundle_id, {BT_SQL.replace('bundle_id', 'bi.bundle_id')} AS bundle_type, list_sort(list_distinct(list(p.category))) AS categories
FROM bundle_items bi JOIN products p USING (product_id) GROUP BY 1, 2"""
