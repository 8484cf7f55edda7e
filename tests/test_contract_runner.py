"""The contract runner, the catalog and the rescuing reader on hand-made tables."""

import pytest
from pyspark.sql import functions as F

from aislekit.operators import contract_runner as R
from aislekit.operators import profile as P
from aislekit.sources import catalog, rescue

SHOP = catalog.parse(r"""
shops pk(shop_id)
  shop_id string ! /^S[0-9]+$/
  kind string =store_type
  size int 1..9
  opened date
  open bool

sales pk(sale_id) unique(shop_id,day)
  sale_id string !
  shop_id string ! >shops.shop_id
  day string
  paid float 0..
  tags list[string] >>shops.shop_id once
  parts list[dict] >>shops.shop_id:id once
""")


def rules(df):
    return {(r["table_name"], r["rule"], r["column_name"]): (r["checked"], r["failed"], r["sample"]) for r in df.collect()}


@pytest.fixture
def frames(spark):
    shops = spark.createDataFrame(
        [("S1", "Mall", "3", "2020-01-01", "true"), ("S2", "Kiosk", "3.0", "2020-02-30", "True"), ("s3", None, "12", None, "yes"),
         ("S1", "Online", "x", "2021-05-05 10:00:00", None), (None, "Mall", "0", "2020-01-01", "FALSE")],
        "shop_id string, kind string, size string, opened string, open string")
    sales = spark.createDataFrame(
        [("a", "S1", "mon", "1.5", '["S1", "S2"]', '[{"id": "S1"}]'), ("b", "S1", "mon", "-2", "['S1', 'S1']", '[{"id": "S9"}, {"id": "S9"}]'),
         ("c", "S7", None, "1e3", "[]", "[]"), ("d", "S7", None, ".5", "[S1]", "none"), ("e", "S2", "tue", "2,5", '[" S7 ", ""]', None)],
        "sale_id string, shop_id string, day string, paid string, tags string, parts string")
    return {"shops": shops, "sales": sales}


def test_rules_on_text_tables(frames):
    got = rules(R.run_contracts(frames, SHOP))
    assert got["shops", "not_null", "shop_id"] == (5, 1, [""])
    assert got["shops", "regex", "shop_id"] == (4, 1, ["s3"])
    assert got["shops", "accepted_values", "kind"] == (4, 1, ["S2"])
    assert got["shops", "type", "size"] == (5, 1, ["S1"])  # 3.0 is a whole number
    assert got["shops", "range", "size"] == (4, 2, [""])  # x is no number: the type rule has it; "" and "s3" share a slot
    assert got["shops", "date", "opened"] == (4, 1, ["S2"])
    assert got["shops", "type", "open"] == (4, 1, ["s3"])
    assert got["shops", "pk_unique", "shop_id"] == (5, 2, ["S1"])
    assert got["sales", "type", "paid"] == (5, 1, ["e"])
    assert got["sales", "range", "paid"] == (4, 1, ["b"])
    assert got["sales", "unique_combination", "shop_id,day"] == (5, 4, ["S1|mon", "S7"])  # missing days are equal
    assert got["sales", "fk", "shop_id"] == (5, 2, ["S7"])
    assert got["sales", "type", "tags"] == (5, 1, ["d"])
    assert got["sales", "list_fk", "tags"] == (5, 1, ["S7"])
    assert got["sales", "list_unique", "tags"] == (5, 2, ["b|S1"])
    assert got["sales", "type", "parts"] == (4, 1, ["d"])
    assert got["sales", "list_fk", "parts"] == (3, 2, ["S9"])
    assert got["sales", "list_unique", "parts"] == (3, 2, ["b|S9"])


def test_counts_and_samples_do_not_depend_on_partitions(frames):
    a = rules(R.run_contracts(frames, SHOP))
    b = rules(R.run_contracts({n: df.repartition(7, F.rand(3)) for n, df in frames.items()}, SHOP))
    assert a == b
    assert all(len(s) <= R.SLOTS for _, _, s in a.values())


def test_rows_are_not_sorted_by_rule(frames):
    plan = R.run_contracts(frames, SHOP)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" in plan


def test_rows_that_break_several_rules(spark, monkeypatch):
    shops = spark.createDataFrame([(f"s{i}", None if i % 2 else "Kiosk", "0" if i % 3 else "x", "never", "?") for i in range(50)],
                                  "shop_id string, kind string, size string, opened string, open string")
    want = rules(R.run_contracts({"shops": shops}, SHOP))
    assert want["shops", "regex", "shop_id"][:2] == (50, 50) and want["shops", "range", "size"][:2] == (33, 33)
    assert want["shops", "accepted_values", "kind"][:2] == (25, 25) and want["shops", "date", "opened"][2] == ["s0", "s1", "s12"]
    monkeypatch.setattr(R, "RULES_AT_ONCE", 2)
    assert rules(R.run_contracts({"shops": shops}, SHOP)) == want


def test_missing_columns_and_parents(frames, spark):
    got = rules(R.run_contracts({**frames, "shops": frames["shops"].drop("size")}, SHOP))
    assert ("shops", "type", "size") not in got
    assert got["shops", "required_column", "shop_id"][:2] == (1, 0)
    no_key = rules(R.run_contracts({"shops": frames["shops"].drop("shop_id")}, SHOP))
    assert no_key["shops", "required_column", "shop_id"][:2] == (1, 1)
    with pytest.raises(ValueError, match="shops is not given"):
        R.run_contracts({"sales": frames["sales"]}, SHOP)


def test_empty_tables(frames):
    got = rules(R.run_contracts({n: df.limit(0) for n, df in frames.items()}, SHOP))
    assert len(got) == len(rules(R.run_contracts(frames, SHOP)))
    assert all(v == (0, 0, []) for k, v in got.items() if k[1] != "required_column")


def test_typed_tables(spark):
    shops = spark.createDataFrame([("S1", "Mall", 3, True), ("S2", "Mall", 11, None)], "shop_id string, kind string, size long, open boolean")
    got = rules(R.run_contracts({"shops": shops}, SHOP))
    assert got["shops", "type", "size"] == (2, 0, []) and got["shops", "range", "size"] == (2, 1, ["S2"])
    wrong = rules(R.run_contracts({"shops": shops.withColumn("open", F.lit(1))}, SHOP))
    assert wrong["shops", "type", "open"][:2] == (2, 2)


def test_catalog_declares_all_tables():
    assert len(catalog.TABLES) == 22
    for t in catalog.TABLES.values():
        names = {c.name for c in t.columns}
        assert t.row_key and set(t.pk) <= names and all(set(u) <= names for u in t.unique)
        for c in t.columns:
            for ref in (c.ref, c.list_ref):
                assert ref is None or ref[1] in {x.name for x in catalog.TABLES[ref[0]].columns}
    assert catalog.TABLES["clickstreams"].schema["campaign_ids"].dataType.simpleString() == "array<string>"


def test_read_keeps_what_breaks_the_schema(spark, tmp_path):
    (tmp_path / "shops.csv").write_text(
        'shop_id,size,opened,open,extra\nS1,3,2020-01-01,True,\nS2,3.0,yesterday,maybe,note\nS3,many\nS4,4,2020-01-01,False,e,f,g\n"S ""5""",,,,\n')
    df = rescue.read_rescued(spark, str(tmp_path / "shops.csv"), SHOP["shops"])
    assert df.columns == ["shop_id", "kind", "size", "opened", "open", "_rescued"]
    got = {r["shop_id"]: (r["kind"], r["size"], str(r["opened"]), r["open"], r["_rescued"]) for r in df.collect()}
    assert got["S1"] == (None, 3, "2020-01-01", True, {})
    assert got["S2"] == (None, 3, "None", None, {"opened": "yesterday", "open": "maybe", "extra": "note"})
    assert got["S3"][1] is None and got["S3"][4] == {"size": "many", "_line": "S3,many"}
    assert got["S4"][1] == 4 and got["S4"][4]["_line"] == "S4,4,2020-01-01,False,e,f,g"
    assert got['S "5"'] == (None, None, "None", None, {})
    report = {r["column_name"]: (r["rescued"], r["sample"]) for r in rescue.rescue_report(df, SHOP["shops"]).collect()}
    assert report["size"] == (1, ["many"]) and report["_line"][0] == 2


def test_profiles_skip_missing_and_report_failing_tables(spark, tmp_path):
    good = spark.createDataFrame([(1, ["missing x"]), (2, [])], "n int, error_types array<string>")

    def failing():
        return good.withColumn("n", F.raise_error(F.lit("bad block")).cast("int"))

    got = {r["dataset"]: r for r in P.profile_sources(spark, {
        "good": lambda: good, "gone": lambda: spark.read.parquet(str(tmp_path / "gone.parquet")), "bad": failing}, {"bad": ["n"]}).collect()}
    assert got["good"]["status"] == "profiled" and got["good"]["dirty_ratio"] == 0.5 and got["good"]["top_error"] == "missing x"
    assert got["gone"]["status"] == "missing" and got["gone"]["total_rows"] is None
    assert got["bad"]["status"] == "failed" and "bad block" in got["bad"]["detail"]


def test_text_report_lines(spark):
    df = spark.createDataFrame([(1.0, ["missing x"]), (2.0, ["missing x", "future y"]), (3.0, []), (4.0, None)], "n double, error_types array<string>")
    got = [(r["section"], r["line"], r["text"]) for r in P.text_report(df, "shops", ["n"]).collect()]
    assert got[:3] == [(1, 1, "shops: 4 rows, 2 dirty, 2 clean, health 50.00"), (2, 1, "missing x: 2"), (2, 2, "future y: 1")]
    assert (3, 1, "0 errors: 2 rows") in got and (4, 1, "medium: 2") in got and (4, 2, "high: 1") in got
    assert got[-1] == (5, 1, "n: mean 2.50, median 2.50, std 1.29, min 1.00, max 4.00")  # too few values for outliers
    assert [t for *_, t in got] == [r["text"] for r in P.text_report(df.repartition(3), "shops", ["n"]).collect()]


def test_queries_on_raw_tables_touch_only_their_own(spark, tables, monkeypatch):
    from aislekit.plans import contracts_all, sources_all
    from aislekit.sources.tables import Tables

    asked = []
    monkeypatch.setattr(contracts_all, "raw_table", lambda t, n, real=contracts_all.raw_table: asked.append(n) or real(t, n))
    reads = [(sources_all.s01_campaigns, {"campaigns"}), (sources_all.s01_customers, {"customers"}), (contracts_all.v13_raw, {"transactions", "promotions"}),
             (contracts_all.v08_raw, {"clickstreams", "customers", "stockout_events", "stores"}),
             (contracts_all.v12_raw, {n for n, t in catalog.TABLES.items() if any(c.pattern for c in t.columns)})]
    for fn, want in reads:
        asked.clear()
        t = Tables(spark, tables.sf_dir)
        fn(t)
        assert set(asked) == want and not any(k.startswith("__raw_") and not k.startswith("__raw_view_") for k in t._frames)
