"""Operators that replaced single-task plans, against plain computations."""

import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislekit.operators import affinity as A
from aislekit.operators import basket as B
from aislekit.operators import checks as X
from aislekit.operators import clickstream as K
from aislekit.operators import faults as E
from aislekit.operators import inventory as I
from aislekit.operators import lookups as J
from aislekit.operators import profile as P
from aislekit.operators.sequence import may_be_hot, numbered, running_max


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [5.0] * 9, [float(x % 7) for x in range(100)], [x / 3 for x in range(1001)]])
def test_quantiles_are_exact(spark, values):
    rng = random.Random(1)
    rows = [(v, -v * v) for v in values] + [(None, None)] * 3
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "a double, b double").withColumn("none", F.lit(None).cast("double"))
    got = {(r["column_name"], r["prob"]): (r["n"], r["value"]) for r in P.exact_quantiles(df, ["a", "b", "none"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    assert {c for c, _ in got} == {"a", "b"}
    for (c, p), (n, v) in got.items():
        xs = values if c == "a" else [-x * x for x in values]
        assert n == len(values) and v == pytest.approx(np.quantile(xs, p), abs=1e-12)


def test_numbering_has_no_gaps(spark):
    ids = random.Random(2).sample(range(10_000), 700)
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    got = {r["k"]: r["n"] for r in numbered(df, ["k"], "n").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(ids))}
    assert numbered(df.limit(0), ["k"], "n").collect() == []


def test_running_max_over_buckets(spark):
    rng = random.Random(3)
    rows = [(1, dt.datetime(2024, 1 + i % 12, 1 + i % 28), i, rng.choice([None, rng.randint(0, 99)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, at timestamp_ntz, i int, v int")
    far = None
    want = {}
    for _, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        far = v if far is None else far if v is None else max(far, v)
        want[i] = far
    assert {r["i"]: r["m"] for r in running_max(df, ["k"], ["at", "i"], "v", "m").collect()} == want


def test_stockout_windows_are_stabbed(spark):
    rng = random.Random(4)
    day = dt.date(2024, 1, 1)
    windows = [(rng.randint(1, 2), rng.randint(1, 2), day + dt.timedelta(a), day + dt.timedelta(a + rng.randint(-2, 60)) if rng.random() < 0.9 else None)
               for a in (rng.randint(0, 300) for _ in range(60))]
    rows = [(i, rng.randint(1, 2), rng.randint(1, 3), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 8000)), rng.choice([0, 5])) for i in range(300)]
    rows += [(300, 1, 1, None, 5)]
    led = spark.createDataFrame([(*r, 1) for r in rows], "i int, store_id int, product_id int, event_timestamp timestamp_ntz, stock_after int, delta int")
    win = spark.createDataFrame(windows, "store_id int, product_id int, stockout_start_date date, stockout_end_date date")
    midnight = lambda d: dt.datetime(d.year, d.month, d.day)
    want = Counter((i, s) for i, st, pr, at, q in rows if at for a, b, s, e in windows if e and (a, b) == (st, pr) and midnight(s) <= at <= midnight(e))
    got = Counter((r["i"], r["__start"]) for r in X.stock_not_zero_in_stockout(led, win).collect())
    assert got == want and want


def test_terms_meet_names_on_their_rarest_gram(spark):
    rng = random.Random(5)
    names = [(i, rng.choice(["common prefix", "COMMON thing", "x", "ab", "Ünlü"]) + rng.choice(["", " alpha", " beta", f" z{i}q"])) for i in range(200)] + [(900, None), (901, "")]
    terms = ["common", "z17q", "common prefix z3", "a", "AB", "x", "ü", "nowhere", "", None, "common"]
    n = spark.createDataFrame(names, "id int, name string")
    t = spark.createDataFrame([(x,) for x in terms], "term string")
    want = {(x, i) for x in terms if x for i, s in names if s is not None and x.lower() in s.lower()}
    got = J.name_contains(t, "term", n, "name").select("term", "id").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_windows_around(spark):
    d = lambda x: dt.date(2020, 1, 1) + dt.timedelta(x)
    rng = random.Random(6)
    outer = [(i, rng.choice("ab"), d(s), d(s + rng.randint(-5, 900))) for i, s in ((i, rng.randint(0, 1500)) for i in range(80))] + [(99, "a", None, d(3))]
    inner = [(i, rng.choice("ab"), d(s), d(s + rng.randint(0, 60))) for i, s in ((i, rng.randint(0, 1500)) for i in range(30))]
    o = spark.createDataFrame(outer, "o int, k string, os date, oe date")
    i = spark.createDataFrame(inner, "i int, k string, s date, e date")
    got = sorted((r["o"], r["i"]) for r in J.windows_around(o, "os", "oe", i, "s", "e", ["k"]).collect())
    assert got == sorted((a, b) for a, k, x, y in outer if x for b, l, s, e in inner if k == l and x <= s and y >= e)


def test_versions_of_one_day_are_ordered(spark):
    day = dt.date(2020, 1, 1)
    rows = [(1, "Active", day, None, day, False), (1, "Discontinued", day, dt.date(2021, 1, 1), day, True),
            (2, "New", day, None, day, False), (2, "Seasonal", dt.date(2020, 2, 1), None, day, False)]
    df = spark.createDataFrame(rows, "product_id int, status string, launch_date date, discontinuation_date date, valid_from date, is_current boolean")
    for part in (df, df.orderBy(F.desc("status")).coalesce(1), df.repartition(4)):
        got = {r["product_id"]: (r["launch_date"], r["discontinuation_date"]) for r in J.launch_lookup(part).collect()}
        assert got == {1: (day, dt.date(2021, 1, 1)), 2: (dt.date(2020, 2, 1), None)}


def test_co_affinity(spark):
    rng = random.Random(7)
    lines = [(b, rng.choice("abcdef"), i) for b in range(300) for i in range(rng.randint(1, 5))] + [(None, "a", 1), (7, None, 2)]
    df = spark.createDataFrame(lines, "transaction_id int, category string, product_id int")
    sets = defaultdict(set)
    for b, c, _ in lines:
        if b is not None and c is not None:
            sets[b].add(c)
    pairs, own = Counter(), Counter()
    for s in sets.values():
        own.update(s)
        pairs.update((x, y) for x in s for y in s if x != y)
    want = set()
    for c in own:
        best = sorted(((n, y) for (x, y), n in pairs.items() if x == c), key=lambda p: (-p[0], p[1]))[:3]
        want |= {(c, y, n, round(n / own[c], 6), i + 1) for i, (n, y) in enumerate(best)}
    near = A.co_affinity(df)
    assert {tuple(r) for r in near.collect()} == want
    focus = {r["transaction_id"]: (r["seed"], r["lines"], r["inside"]) for r in A.basket_focus(df, near).collect()}
    for b in sets:
        mine = [(p, c) for x, c, p in lines if x == b and c is not None]
        seed = min(mine)[1]
        around = {seed} | {y for x, y, *_ in want if x == seed}
        assert focus[b] == (seed, len(mine), sum(c in around for _, c in mine))
    assert A.co_affinity(df.limit(0)).collect() == []


def _shop(spark):
    """Carts with a null id, repeated headers and promotions, and a product in every scope."""
    day = dt.date(2024, 1, 10)
    lines = [(t, p, "AB"[p % 2], 1 + (t or 0) % 3, 10.5 * p) for t in (1, 2, 3, 4, None) for p in (1, 2, 3, 4) if ((t or 0) + p) % 5]
    lines = spark.createDataFrame(lines, "transaction_id long, product_id long, category string, quantity long, unit_price double").withColumn(
        "unit_price", F.col("unit_price").cast("decimal(18,2)"))
    heads = [(t, t, t % 2, dt.datetime(2024, 1, 10 + t)) for t in (1, 2, 2, 3, 4)] + [(None, 1, 1, dt.datetime(2024, 1, 12))]
    heads = spark.createDataFrame(heads, "transaction_id long, customer_id long, store_id long, transaction_time timestamp_ntz")
    promos = [(1, "product", "dollar_discount", "3", 3, None, 3), (1, "product", "dollar_discount", "3", 3, None, 3), (2, "category", "percentage_discount", "A", 10, None, 2),
              (2, "category", "percentage_discount", "B", 10, None, 2), (3, "bundle", "bundle", "7", 0, None, 4), (4, "cart", "free_shipping", None, 0, 50, 1),
              (5, "product", "percentage_discount", "2", 20, None, None), (6, None, "percentage_discount", "2", 20, None, 3)]
    promos = spark.createDataFrame([(*r, day, day + dt.timedelta(40)) for r in promos],
                                   "promotion_id long, promotion_scope string, promotion_mechanic string, promotion_target_id string, promotion_value int, min_spend int, "
                                   "priority int, effective_start_date date, effective_end_date date")
    members = spark.createDataFrame([(7, 1, 1), (7, 2, 1), (8, 4, 9)], "bundle_id long, product_id long, quantity long")
    prices = spark.createDataFrame([(1, 7, 20, day, day + dt.timedelta(40))],
                                   "bundle_pricing_id long, bundle_id long, bundle_price int, effective_start_date date, effective_end_date date")
    where = [spark.createDataFrame([(i, f"r{i % 2}", f"a{i}") for i in range(4)], f"{k} long, region string, area string") for k in ("customer_id", "store_id")]
    return lines, heads, promos, members, prices, *where


def test_priced_stages_stay_with_their_cart(spark):
    shop = _shop(spark)
    cut, whole = B.price_baskets(*shop), B.price_baskets(*shop, materialize=False)
    for name in ("discounts", "covers", "items"):
        rows = [sorted(map(str, p[name].collect())) for p in (cut, whole)]
        assert rows[0] and rows[0] == rows[1], name
    for df in (B.reconcile(cut["transactions"], cut["items"]), B.promotion_conflicts(cut["covers"]), cut["allocation"], cut["transactions"]):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(transaction_id" not in plan
    assert {r["product_id"] for r in cut["allocation"].where("promotion_id = 3").collect()} <= {1, 2}


def test_stock_history_without_hot_keys_is_shuffled_once(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2]), rng.choice([None, 1, 2, 3]), at and dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * at), rng.choice([None, -40, -9, -3, 0, 3, 9, 40]))
            for at in [None, *range(1, 600)]]
    movements = spark.createDataFrame(rows, "store_id long, product_id long, event_timestamp timestamp_ntz, delta long")
    assert may_be_hot(movements, ["store_id", "product_id"], most=40) and not may_be_hot(movements, ["store_id", "product_id"], most=600)
    assert not may_be_hot(movements.limit(0), ["store_id"])
    made = {}
    for split in (True, False):
        led = I.stock_ledger(movements, split=split)
        snaps = I.sparse_changes(led, split=split)
        made[split] = [Counter(tuple(r[c] for c in sorted(r.asDict())) for r in d.collect()) for d in (led, snaps, X.ledger_inconsistent(led, split))]
    assert made[True] == made[False] and len(made[True][0]) > len(made[True][1]) > 0
    snaps = I.sparse_changes(I.stock_ledger(movements, split=False), split=False)
    assert snaps._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("mode", ["arith", "xxhash"])
def test_draws_under_a_rate(spark, mode):
    rates = [-0.5, 0.0, 1e-13, 0.02, 1 / 3, 0.5, 1.0, 1.5]
    df = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("k"))
    for i, rate in enumerate(rates):
        want = E.draw(F.col("k"), i, mode) < rate
        assert df.where(~want.eqNullSafe(E.drawn_under(F.col("k"), i, rate, mode))).count() == 0


def test_copies_come_from_one_pass(spark):
    df = spark.createDataFrame([(i, ["a"] if i % 2 else ["duplicate row"]) for i in range(500)] + [(None, [])], "id int, error_types array<string>")
    out = E.duplicate_rows(df, 0.3, "duplicate row", F.col("id"), 3, "arith")
    drawn = {r["id"] for r in df.where(E.draw(F.col("id"), 3, "arith") < 0.3).collect()}
    want = Counter((i, tuple(e)) for i, e in map(tuple, df.collect()))
    want += Counter((i, ("a", "duplicate row") if i % 2 else ("duplicate row",)) for i in drawn)
    assert Counter((r["id"], tuple(r["error_types"])) for r in out.collect()) == want and drawn
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_enriched_clicks_without_hot_keys(spark):
    rng = random.Random(12)
    kinds = ["Add to Cart", "Add to Cart", "Product View", "Payment Successful", "Remove from Cart"]
    rows = []
    for i in range(400):
        c, day = rng.choice([None, 1, 2, 3]), rng.randint(1, 60)
        rows.append((i, c, dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=i), rng.choice(kinds), rng.randint(1, 4), f"{c}_{day}" if c else None))
    clicks = spark.createDataFrame(rows, "event_id long, customer_id long, event_timestamp timestamp_ntz, event_type string, product_id long, session_id string")
    products = spark.createDataFrame([(1, "a", "x"), (2, "b", "y y")], "product_id long, product_name string, category string")
    whole, split = (K.enrich_clickstream(clicks, products, s) for s in (False, True))
    assert whole.columns == split.columns and whole.dtypes == split.dtypes
    assert Counter(map(str, whole.collect())) == Counter(map(str, split.collect()))
    exchanges = [d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for d in (whole, split)]
    assert exchanges[0] * 2 < exchanges[1]


def test_listings_keep_the_greatest_texts(spark):
    from aislekit.sources.adapters import ADAPTERS, adapter_frame

    class Some:
        def __init__(self, frames):
            self.spark, self.table = spark, frames.__getitem__

    rng = random.Random(13)
    parts = [(rng.choice([None, 17, 23, 1, 2, 3]), rng.choice([None, "pa", "pb"]), rng.choice([None, "ba", "bb"]), rng.choice(["ta", "tb"]),
              rng.choice([None, 1.5, 2.25])) for _ in range(12)]
    lines = [(rng.choice([None, 1, 2]), rng.choice([None, 17, 23, 1, 2, 3, 9])) for _ in range(80)]
    frames = {"part": spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
              "lineitem": spark.createDataFrame(lines, "l_suppkey long, l_partkey long")}
    want, got = spark.sql(ADAPTERS["store_catalogues"], **frames), adapter_frame(Some(frames), "store_catalogues")
    assert got.dtypes == want.dtypes and Counter(got.collect()) == Counter(want.collect())


def test_shares_are_summed_without_another_join(spark):
    rows = [(t, p, l, float(1 + (t * 7 + l) % 5)) for t in range(20) for p in range(3) for l in range(1 + t % 4)]
    lines = spark.createDataFrame(rows, "transaction_id long, promotion_id long, product_id long, v double").select(
        "transaction_id", "promotion_id", "product_id", F.col("v").cast("decimal(38,6)").alias("line_total"))
    promos = lines.groupBy("transaction_id", "promotion_id").agg(F.sum("line_total").alias("elig_subtotal"), F.max("product_id").alias("last_pid")).withColumn(
        "discount", F.col("promotion_id").cast("decimal(18,2)"))
    out = B.allocate(promos, lines)
    sums = {(r["transaction_id"], r["promotion_id"]): r["s"] for r in out.groupBy("transaction_id", "promotion_id").agg(F.sum("allocated").alias("s")).collect()}
    assert len(sums) == 60 and all(s == p for (_, p), s in sums.items())
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_carts_meet_promotions_as_given(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    lines = spark.createDataFrame([(t, p, f"c{p % 2}", 1 + t % 3, "4.00") for t in range(9) for p in range(4)], "transaction_id long, product_id long, category string, quantity long, p string")
    lines = lines.withColumn("unit_price", F.col("p").cast("decimal(18,2)"))
    headers = spark.createDataFrame([(t, day(1 + t)) for t in range(9)], "transaction_id long, transaction_time timestamp_ntz")
    scopes = [("product", "1"), ("category", "c0"), ("cart", None), ("bundle", "5")]
    promotions = spark.createDataFrame([(10 * i + j, s, "percentage_discount", k, 5.0, m, 1, day(2), day(7)) for i, (s, k) in enumerate(scopes) for j, m in enumerate([None, 30.0])],
                                       "promotion_id long, promotion_scope string, promotion_mechanic string, promotion_target_id string, promotion_value double, min_spend double, priority int, "
                                       "effective_start_date timestamp_ntz, effective_end_date timestamp_ntz")
    members = spark.createDataFrame([(5, 1, 1), (5, 2, 2)], "bundle_id long, product_id long, quantity long")
    want = B.eligible_promotions(lines, headers, promotions, members)
    carts = B._cut(B.timed_carts(lines, headers), True)
    got = B.eligible_promotions(lines, headers, promotions, members, carts)
    assert Counter(got.collect()) == Counter(want.collect()) and want.count() == sum((1 + (4 * 4 * (1 + t % 3) >= 30)) * (3 + (t % 3 > 0)) for t in range(1, 7))
    # a cart's subtotal is not made again for every scope
    assert got._jdf.queryExecution().optimizedPlan().toString().count("sum(") < want._jdf.queryExecution().optimizedPlan().toString().count("sum(")
