"""Cart contents, sequence faults and the session detector against plain computations."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from aislekit.operators import cart as C
from aislekit.operators import click_sequence as CS
from aislekit.operators import clickstream as K

T0 = dt.datetime(2024, 1, 31, 22)
TYPES = ["Add to Cart"] * 5 + ["Remove from Cart"] * 2 + ["Payment Successful", "Home View"]


@pytest.fixture(scope="module")
def events():
    rng = random.Random(4)
    rows, at = [], T0
    for i in range(900):
        customer = 1 if rng.random() < 0.4 else rng.randint(2, 9)  # one customer with much of the table
        at += dt.timedelta(minutes=rng.randint(0, 90))
        rows.append((i, customer, f"{customer}_{at.date()}", at, rng.choice(TYPES), rng.randint(1, 6)))
    return rows


@pytest.fixture(scope="module")
def placed(spark, events):
    df = spark.createDataFrame(events, "event_id long, customer_id long, session_id string, event_timestamp timestamp_ntz, event_type string, product_id long")
    return C.positions(K.cart_replay(K.event_order(df.repartition(5)))).cache()


def replay(events):
    """Cart after each event, what each payment buys, and each event's place in its session."""
    carts, after, bought, order = defaultdict(Counter), {}, {}, Counter()
    place = {}
    for i, customer, session, at, kind, product in sorted(events, key=lambda e: (e[3], e[0])):
        cart = carts[customer]
        if kind == "Add to Cart":
            cart[product] += 1
        elif kind == "Remove from Cart":
            cart[product] -= 1
        elif kind == "Payment Successful":
            bought[i] = {p: n for p, n in cart.items() if n > 0}
            cart.clear()
        after[i] = {p: n for p, n in cart.items() if n > 0}
        order[session] += 1
        place[i] = (session, order[session])
    return after, bought, place


def test_contents_and_purchases(placed, events):
    after, bought, _ = replay(events)
    got = defaultdict(dict)
    for r in C.cart_contents(placed).collect():
        got[r["event_id"]][r["product_id"]] = r["n"]
    assert dict(got) == {i: c for i, c in after.items() if c}
    got = defaultdict(dict)
    for r in C.purchased_rows(placed).collect():
        got[r["event_id"]][r["product_id"]] = r["quantity"]
    assert dict(got) == {i: c for i, c in bought.items() if c}


@pytest.mark.parametrize("kind,step", [("Add to Cart", 1), ("Remove from Cart", -1)])
def test_wrong_changes(placed, events, kind, step):
    after, _, place = replay(events)
    broken = {i: dict(c) for i, c in after.items()}
    for i in list(broken)[::37]:
        broken[i] = {}
    for i in list(broken)[::53]:
        broken[i][99] = 2
    rows = [(i, p, n) for i, c in broken.items() for p, n in c.items()]
    contents = placed.sparkSession.createDataFrame(rows, "event_id long, product_id long, n long")
    at = {v: k for k, v in place.items()}
    want = set()
    for i, _, _, _, t, product in events:
        session, order = place[i]
        if t != kind or order == 1:
            continue
        now, then = Counter(broken[i]), Counter(broken[at[session, order - 1]])
        changed = {p: now[p] - then[p] for p in now | then if now[p] != then[p]}
        if changed != {product: step}:
            want.add((i, changed.get(product, 0), len(changed.keys() - {product})))
    got = {tuple(r) for r in C.wrong_cart_changes(placed, contents, kind).select("event_id", "own_change", "other_changes").collect()}
    assert got == want and want


def test_no_list_per_customer_in_the_plan(placed):
    plan = C.cart_contents(placed)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan


def test_broken_carts_keep_half_or_explode(spark):
    contents = spark.createDataFrame([(i, p, 3) for i in range(400) for p in (1, 2)], "event_id long, product_id long, n long")
    hits = spark.createDataFrame([(i, i % 2 == 0) for i in range(400)], "event_id long, hit boolean")
    after, labels = C.break_carts(hits, contents)
    items = {r["event_id"]: r["s"] for r in after.groupBy("event_id").agg(F.sum("n").alias("s")).collect()}
    found = {r["event_id"]: (r["label"], r["items"]) for r in labels.collect()}
    assert all(i % 2 == 0 for i in found) and {v[0] for v in found.values()} == {"partial cart loss", "cart reset", "cart is none", "cart explosion"}
    for i in range(400):
        label, n = found.get(i, (None, 6))
        assert items.get(i, 0) == (n or 0)
        assert (label != "partial cart loss" or n == 3) and (label != "cart explosion" or 16 <= n <= 36)


def test_sequence_faults_insert_and_renumber(spark):
    rows = [(s * 1000 + i, f"s{s}", i + 1, ["Product View", "Home View"][i % 2], T0 + dt.timedelta(minutes=i), i, "c", f"/p/{s}/{i}")
            for s, n in ((0, 1), (1, 40), (2, 2500)) for i in range(n)]
    e = spark.createDataFrame(rows, "event_id long, session_id string, event_order long, event_type string, event_timestamp timestamp_ntz, "
                                    "product_id long, category string, page string").withColumn("__sel_wrong_event_sequence", F.lit(True))
    out = CS.sequence_faults(e).collect()
    by_session = defaultdict(list)
    for r in out:
        by_session[r["session_id"]].append(r)
    pages = defaultdict(set)
    for r in rows:
        pages[r[1]].add(r[7])
    labels = Counter()
    for s, rs in by_session.items():
        rs.sort(key=lambda r: r["event_order"])
        assert [r["event_order"] for r in rs] == list(range(1, len(rs) + 1))
        last = None
        for r in rs:
            assert r["page"] in pages[s]
            labels.update(r["error_types"])
            if r["event_id"] < 0:
                assert last["event_id"] == -r["event_id"] - 1  # right after the event that drew it
                if r["error_types"] == ["replay event"]:
                    assert int(r["page"].rsplit("/", 1)[1]) % 2 == 0  # the page of a product view
            last = r
    assert set(labels) == {"impossible event sequence", "event repeat", "random backtracking", "replay event"}
    n = sum(1 for r in out if r["event_id"] >= 0)
    assert n == len(rows) and abs(labels["event repeat"] / n - 0.05) < 0.02


def test_detector_on_hand_made_sessions(spark):
    s = dt.timedelta(seconds=1)
    rows = [(i, "human", T0 + i * 600 * s, "Home View" if i == 0 else "Product View", i, "/p") for i in range(5)]
    rows += [(10, "human", T0 + 1203 * s, "Product View", 2, "/p"), (11, "human", T0 + 1805 * s, "Product View", 3, "/p")]
    rows += [(20 + i, "bot", dt.datetime(2024, 2, 1, 0, 59, 50) + i * 5 * s, "Search View", None, f"/s{i}") for i in range(4)]  # over the full hour
    rows += [(30 + i, "stray", T0 + i * 200 * s, "Cart View", None, f"/c{i}") for i in range(3)]
    rows += [(40, None, None, "Home View", None, None)]
    df = spark.createDataFrame(rows, "row_id long, session_id string, event_timestamp timestamp_ntz, event_type string, product_id long, page string")
    got = {r["row_id"]: r["detected"] for r in CS.detect_sessions(df).collect()}
    assert {i for i, d in got.items() if "duplicate event" in d} == {10}
    assert {i for i, d in got.items() if "bot traffic" in d} == {20, 21, 22, 23}
    assert {i for i, d in got.items() if "orphan session" in d} == {30, 31, 32}
    assert len(got) == len(rows)


def test_change_sets_of_some_places(spark, placed):
    contents, places = C.cart_contents(placed), placed.where("event_id % 3 = 0").select("session_id", "event_order")
    every = Counter(map(tuple, C.change_sets(placed, contents).collect()))
    wanted = set(map(tuple, places.collect()))
    got = Counter(map(tuple, C.change_sets(placed, contents, places).collect()))
    assert got == Counter({r: n for r, n in every.items() if r[:2] in wanted})
    assert 0 < len(got) < len(every)
