"""Hand-made frames and properties for the operators."""

from decimal import Decimal

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from aislekit.operators import basket as B
from aislekit.operators import faults as E
from aislekit.operators import lookups as J
from aislekit.operators import profile as P
from aislekit.operators import quality as Qd
from aislekit.operators.sequence import asof_lookup, carry_forward, neighbour, running_sum


def test_stack_fold_replaces_only_when_strictly_better(spark):
    pp = spark.createDataFrame(
        [(1, 10, "percentage_discount", 3, "5.00"), (1, 11, "percentage_discount", 2, "7.00"),
         (1, 12, "dollar_discount", 3, "2.00"), (2, 20, "dollar_discount", 3, "1.00"), (2, 21, "dollar_discount", 2, "1.00")],
        "transaction_id long, promotion_id long, promotion_mechanic string, priority int, discount string",
    ).withColumn("discount", F.col("discount").cast("decimal(18,2)"))
    cv = spark.createDataFrame([(1, 10, ["a"]), (1, 11, ["a", "b"]), (1, 12, ["c"]), (2, 20, ["z"]), (2, 21, ["z"])],
                               "transaction_id long, promotion_id long, cover array<string>")
    got = {(r.transaction_id, r.promotion_id) for r in B.resolve_stack(pp, cv).collect()}
    # cart 1: 11 (7.00) beats 10 (5.00); cart 2: equal discount does not displace
    assert got == {(1, 11), (1, 12), (2, 20)}


def test_allocation_sums_to_discount(tables):
    p = B.price_baskets(tables.view("basket_items"), tables.view("transactions"), tables.view("promotions"),
                        tables.view("bundle_items"), tables.view("bundle_pricings"), materialize=False)
    sums = p["allocation"].groupBy("transaction_id", "promotion_id").agg(F.sum("allocated").alias("s"))
    j = sums.join(p["discounts"].select("transaction_id", "promotion_id", "discount"), ["transaction_id", "promotion_id"])
    bad = j.where((F.col("discount") > 0) & (F.col("s") != F.col("discount"))).count()
    assert bad == 0


def test_reconcile_holds_on_priced_baskets(tables):
    p = B.price_baskets(tables.view("basket_items"), tables.view("transactions"), tables.view("promotions"),
                        tables.view("bundle_items"), tables.view("bundle_pricings"), materialize=False)
    assert B.reconcile(p["transactions"], p["items"]).count() == 0


def _hot_key_frame(tables):
    # every line under ONE key: the worst skew, from the driver table
    li = tables.lineitem.select(F.lit(1).alias("k"), "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    return li.dropDuplicates(["l_shipdate", "l_orderkey", "l_linenumber"])


def test_bucketed_sequence_equals_plain_window(tables):
    d = _hot_key_frame(tables)
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    w = Window.partitionBy("k").orderBy(*order)
    plain = d.select(*order, F.lag("l_quantity").over(w).alias("p"), F.lead("l_quantity").over(w).alias("n"),
                     F.sum("l_quantity").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s")).toPandas()
    a = neighbour(d, ["k"], order, ["l_quantity"], "prev").select(*order, F.col("prev_l_quantity").alias("p"))
    b = neighbour(d, ["k"], order, ["l_quantity"], "next").select(*order, F.col("next_l_quantity").alias("n"))
    c = running_sum(d, ["k"], order, "l_quantity", "s").select(*order, "s")
    got = a.join(b, order).join(c, order).toPandas()
    m = plain.merge(got, on=order, suffixes=("_w", "_b"))
    assert len(m) == len(plain)
    for col in ["p", "n", "s"]:
        assert ((m[f"{col}_w"] == m[f"{col}_b"]) | (m[f"{col}_w"].isna() & m[f"{col}_b"].isna())).all()


def test_carry_forward_matches_last_ignorenulls(tables):
    d = _hot_key_frame(tables).withColumn("v", F.when(F.col("l_quantity") > 40, F.col("l_orderkey")))
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = d.select(*order, F.last("v", ignorenulls=True).over(w).alias("x")).toPandas()
    got = carry_forward(d, ["k"], order, "v", "x").select(*order, "x").toPandas()
    m = plain.merge(got, on=order)
    assert ((m.x_x == m.x_y) | (m.x_x.isna() & m.x_y.isna())).all()


def test_asof_matches_brute_force(spark):
    facts = spark.createDataFrame([(1, "2020-01-01 00:00:00", "A"), (1, "2020-01-05 00:00:00", "B"), (2, "2020-02-01 00:00:00", "C")],
                                  "k int, ts string, v string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    probes = spark.createDataFrame([(1, "2019-12-31 00:00:00"), (1, "2020-01-05 00:00:00"), (1, "2020-03-01 00:00:00"),
                                    (2, "2020-01-31 00:00:00"), (3, "2020-01-01 00:00:00")],
                                   "k int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = sorted((r.k, str(r.at), r.v) for r in asof_lookup(probes, facts, ["k"], "at", "ts", "v", "v", default="none").collect())
    assert got == [(1, "2019-12-31 00:00:00", "none"), (1, "2020-01-05 00:00:00", "B"), (1, "2020-03-01 00:00:00", "B"),
                   (2, "2020-01-31 00:00:00", "none"), (3, "2020-01-01 00:00:00", "none")]


def test_name_contains_matches_brute_force(tables):
    p = tables.view("products").select("product_id", "product_name")
    terms = p.select(F.explode(F.split("product_name", " ")).alias("term")).distinct()
    got = {(r.term, r.product_id) for r in J.name_contains(terms, "term", p, "product_name").select("term", "product_id").collect()}
    pdf, tdf = p.toPandas(), terms.toPandas()
    want = {(t, pid) for t in tdf.term for pid, n in zip(pdf.product_id, pdf.product_name)
            if n is not None and t.lower() in n.lower()}
    assert got == want


def test_pick_store_gives_each_customer_one_store(tables):
    out = J.pick_store(tables.view("customers"), tables.view("stores"))
    c = tables.view("customers").count()
    assert out.count() == c and out.select("customer_id").distinct().count() == c
    assert out.where(F.col("store_id").isNull()).count() == 0


def test_faults_repeat_after_repartition(tables):
    c = tables.view("customers")
    a = E.inject_nulls(c, "email", 0.3, "missing email", F.col("customer_id"), 5)
    b = E.inject_nulls(c.repartition(7), "email", 0.3, "missing email", F.col("customer_id"), 5)
    key = ["customer_id", "email"]
    assert sorted(map(tuple, a.select(*key).collect()), key=repr) == sorted(map(tuple, b.select(*key).collect()), key=repr)


def test_detector_finds_injected_value_faults(tables):
    from aislekit.plans.fault_plans import PLANS

    faulted = E.apply_plan(tables.view("customers"), PLANS["customers"]["steps"], "customer_id")
    found = Qd.detect_customers(faulted.withColumnRenamed("error_types", "injected"))
    rows = found.select("injected", "error_types").collect()
    for lbl in ["future signup date", "invalid date of birth", "negative loyalty points", "missing email"]:
        injected = [r for r in rows if lbl in r.injected]
        assert all(lbl in r.error_types for r in injected), lbl


def test_duplicate_copies_are_labelled(tables):
    t = tables.view("transactions")
    d = E.duplicate_rows(t, 0.2, "duplicate row", F.col("transaction_id"), 3)
    extra = d.count() - t.count()
    assert extra > 0
    assert d.where(F.array_contains("error_types", "duplicate row")).count() == extra


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    r = P.dirty_row_stats(df).collect()[0]
    assert r.total_rows == 0 and r.dirty_ratio == 0.0


def test_money_rounds_half_up(spark):
    r = spark.range(1).select(B.money(F.lit(Decimal("2.675")))).collect()[0][0]
    assert r == Decimal("2.68")


def test_streamed_row_checks_equal_batch(spark, tables):
    from aislekit.operators.checks import row_check_counts
    from aislekit.sources.io import shared_path
    from aislekit.streaming import stream_row_checks

    cust = tables.view("customers")
    src, sink, chk = shared_path(spark, "src"), shared_path(spark, "sink"), shared_path(spark, "chk")
    cust.repartition(3).write.parquet(src)
    q = stream_row_checks(spark, src, cust.schema, "customers", sink, chk)
    q.awaitTermination()
    got = spark.read.parquet(sink).groupBy("check_name").agg(F.sum("failed").alias("f")).collect()
    want = row_check_counts(cust, "customers").collect()
    assert {r.check_name: r.f for r in got} == {r.check_name: r.failed for r in want}


def test_dirty_clickstream_properties(tables):
    from aislekit.operators import click_faults as CF
    from aislekit.operators.clickstream import enrich_clickstream

    e = enrich_clickstream(tables.view("clickstreams"), tables.view("products"))
    d = CF.dirty_clickstream(e, "arith").cache()
    labels = F.col("error_types")
    copies = F.array_contains(labels, "duplicate event") | F.array_contains(labels, "bot traffic") | F.array_contains(labels, "orphan session")
    base = d.where(~copies)
    # every input event comes out exactly once (plus marked copies)
    assert base.count() == e.count() == base.select("event_id").distinct().count()
    # labels stay under the cap on the corrupted originals
    assert base.where(F.size(F.array_distinct(labels)) > 4).count() == 0
    # bot sessions hold 5-20 events; orphan sessions have no landing event
    bots = d.where(F.array_contains(labels, "bot traffic")).groupBy("session_id").count()
    assert bots.where((F.col("count") < 5) | (F.col("count") > 20)).count() == 0
    orph = d.where(F.array_contains(labels, "orphan session"))
    assert orph.where(F.col("event_type") == "Home View").count() == 0
    # clean-profile sessions never get corrupted originals
    b = CF.with_budget(e, "arith").select("event_id", "__budget")
    zero = base.join(b.where(F.col("__budget") == 0), "event_id")
    assert zero.where(F.size(labels) > 0).count() == 0


# ---------------------------------------------------------------- rows that hide mistakes


def test_exclusives_without_an_id_are_not_one_product(spark):
    from aislekit.operators.lookups import competitor_catalogue

    rows = [("c", None, "a", "b"), ("c", None, "d", "b"), ("c", None, "e", "b"), ("c", None, "e", "b"), ("c", 1, "f", "b"), ("c", 1, "g", "b")]
    got = competitor_catalogue(spark.createDataFrame(rows, "competitor string, product_id long, product_name string, brand string"))
    assert sorted((r["product_name"], r["is_exclusive"]) for r in got.collect()) == [("a", True), ("d", True), ("e", True), ("f", False)]


def test_ab_groups_differ_between_campaigns(spark):
    from aislekit.operators.campaigns import ab_split

    aud = spark.range(4).selectExpr("id AS campaign_id").crossJoin(spark.range(500).selectExpr("id AS customer_id")).withColumn(
        "is_ab_test", F.lit(True)).withColumn("start_date", F.lit("2024-01-01").cast("date"))
    for mode in ("arith", "xxhash"):
        rows = ab_split(aud, F.col("is_ab_test"), mode=mode).collect()
        groups = {}
        for r in rows:
            groups.setdefault(r["customer_id"], set()).add(r["assignment_group"])
        assert sum(len(g) == 2 for g in groups.values()) > 350


def test_draws_of_distant_keys_are_independent(spark):
    from aislekit.operators.faults import draw

    d = spark.range(2000).select(draw(F.col("id"), 5, "arith").alias("a"), draw(F.col("id") + 1000003, 5, "arith").alias("b")).collect()
    assert sum(r["a"] == r["b"] for r in d) == 0
    assert abs(sum(r["a"] for r in d) / 2000 - 0.5) < 0.03


def test_page_promotions_are_active_ones(spark):
    from aislekit.operators.lookups import page_promotions

    e = spark.sql("""SELECT * FROM VALUES (1, 'Cart View', 7, 'x', timestamp'2024-03-05 10:00:00'),
        (2, 'Product View', 7, 'x', timestamp'2024-03-05 10:00:00'), (3, 'Cart View', 7, 'x', timestamp'2025-01-01 00:00:00')
        AS t(event_id, event_type, product_id, category, event_timestamp)""")
    p = spark.sql("""SELECT * FROM VALUES (10, 'cart', null, date'2024-03-01', date'2024-03-05'), (11, 'cart', null, date'2024-03-06', date'2024-04-01'),
        (12, 'category', 'x', date'2020-01-01', date'2030-01-01'), (13, 'product', '7', date'2024-01-01', date'2024-03-04'),
        (14, 'bundle', '70', date'2024-03-05', date'2024-03-05')
        AS t(promotion_id, promotion_scope, promotion_target_id, effective_start_date, effective_end_date)""")
    b = spark.sql("SELECT 70 AS bundle_id, 7 AS product_id, 1 AS quantity")
    assert sorted(map(tuple, page_promotions(e, p, b).collect())) == [(1, 10), (2, 12), (2, 14)]


def test_events_without_a_session_stay(spark):
    from aislekit.operators.clickstream import bounce_flags

    rows = [(1, "s"), (2, None), (3, None), (4, "t"), (5, "t")]
    got = bounce_flags(spark.createDataFrame(rows, "event_id long, session_id string")).collect()
    assert sorted((r["event_id"], r["bounce_flag"]) for r in got) == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 0)]


def test_generated_events_have_ids_of_their_own(spark):
    from aislekit.operators.click_faults import bot_sessions, orphan_sessions

    d = spark.range(3000).select(F.col("id").alias("event_id"), (F.col("id") % 50).alias("customer_id"),
                                 F.concat(F.lit("s"), (F.col("id") / 5).cast("int").cast("string")).alias("session_id"),
                                 F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("event_timestamp"),
                                 F.lit("heavy_corruption").alias("__profile"))
    bots = [r["event_id"] for r in bot_sessions(d).collect()]
    orphans = [r["event_id"] for r in orphan_sessions(d).collect()]
    assert bots and orphans and max(bots + orphans) < 0
    assert len(set(bots + orphans)) == len(bots) + len(orphans)


def test_sequences_keep_null_keys_and_times(spark):
    from pyspark.sql import Window

    from aislekit.operators.sequence import carry_forward, neighbour, running_sum

    rows = [(k, t, i, i if i % 3 else None) for i, (k, t) in enumerate(
        (k, t) for k in (None, 1, 2) for t in (None, "2024-01-05", "2024-01-05", "2024-02-01", "2024-04-09"))]
    df = spark.createDataFrame(rows, "k long, d string, i long, v long").withColumn("t", F.col("d").cast("timestamp_ntz"))
    w = Window.partitionBy("k").orderBy("t", "i")
    w0 = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("i", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"), F.sum("i").over(w0).alias("s"),
                     F.last("v", ignorenulls=True).over(w0).alias("c")).collect()
    got = neighbour(neighbour(df, ["k"], ["t", "i"], ["v"]), ["k"], ["t", "i"], ["v"], "next")
    got = carry_forward(running_sum(got, ["k"], ["t", "i"], "i", "s"), ["k"], ["t", "i"], "v", "c")
    pick = lambda rs: sorted((r["i"], r["prev_v"], r["next_v"], r["s"], r["c"]) for r in rs)
    assert [tuple(map(str, r)) for r in pick(got.collect())] == [tuple(map(str, r)) for r in pick(want)]


def test_active_counts_equal_pairing(spark):
    from aislekit.operators.lookups import active_counts

    p = spark.sql("SELECT * FROM VALUES (timestamp'2024-01-01'), (timestamp'2024-01-05'), (timestamp'2024-01-05'), (timestamp'2024-03-01'), (null) AS t(at)")
    i = spark.sql("""SELECT * FROM VALUES (date'2024-01-01', date'2024-01-05'), (date'2024-01-05', date'2024-02-28'), (date'2023-01-01', date'2025-01-01'),
        (date'2024-02-01', date'2024-01-01'), (null, date'2024-01-09') AS t(a, b)""")
    got = active_counts(p, "at", i, "a", "b", "n").collect()
    assert sorted((str(r["ts"])[:10], r["n"]) for r in got) == [("2024-01-01", 2), ("2024-01-05", 3), ("2024-03-01", 1)]


def test_a_free_cart_does_not_fail(spark):
    from aislekit.operators.basket import allocate

    d = spark.sql("SELECT 1 AS transaction_id, 2 AS promotion_id, CAST(0 AS DECIMAL(18,2)) AS discount, CAST(0 AS DECIMAL(18,2)) AS elig_subtotal, 9 AS last_pid")
    lines = spark.sql("""SELECT * FROM VALUES (1, 2, 8, CAST(0 AS DECIMAL(18,2))), (1, 2, 9, CAST(0 AS DECIMAL(18,2)))
        AS t(transaction_id, promotion_id, product_id, line_total)""")
    assert [float(r["allocated"]) for r in allocate(d, lines).collect()] == [0, 0]
