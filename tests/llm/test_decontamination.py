"""Containment search against brute force."""

import re
from math import log

import pytest

from aislekit.llm import decontamination as D


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def shingles(text, k=5):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items, threshold=0.75):
    out = {}
    for i, t in docs:
        for j, q in items:
            k = min(5, len(words_of(q)))  # an item of fewer words is looked for whole
            want = shingles(q, k) if k else set()
            n = len(want & shingles(t, k)) if k else 0
            if want and n >= threshold * len(want):
                out[(i, j)] = (len(want), max(n, out.get((i, j), (0, 0))[1]))
    return out


def result(df):
    rows = df.collect()
    got = {(r["doc_id"], r["item_id"]): (r["n_item"], r["n_shared"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def make_items(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, n_item int")

    return make


ITEM = " ".join(f"w{i}" for i in range(40))
ITEMS = [(1, ITEM), (2, "Short Item"), (3, None), (4, ""), (5, " ".join(f"v{i}" for i in range(11))), (6, ITEM.upper()),
         (None, "an item that has no id at all"), (7, "alpha"), (8, "alpha beta gamma delta"), (9, "w0 w1 w2")]
LONG = " ".join(f"x{i % 7001}y{i}" for i in range(30_000))
DOCS = [(1, f"{LONG} {ITEM} {LONG}"), (2, "short  item"), (3, "a short item"), (4, None), (5, ""), (6, " \n\t "),
        (7, LONG + " " + " ".join(f"w{i}" for i in range(33)) + " end"), (8, " ".join(f"w{i}" for i in range(31)) + " " + LONG),
        (9, "W0\n" + ITEM[3:]), (9, "again " + ITEM), (None, "so an item that has no id at all"),
        (10, " ".join(f"v{i}" for i in range(11)) + " " + LONG), (11, ITEM), (11, ITEM),
        (12, "one two ALPHA beta\tgamma three four five"), (13, "alpha beta gamma deltas"), (14, LONG + " alpha beta gamma delta " + LONG), (15, "alphabet")]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_equals_brute_force(make_docs, make_items, monkeypatch, limit):
    monkeypatch.setattr(D, "BROADCAST_MINIMA", limit)
    monkeypatch.setattr(D, "BROADCAST_IDS", limit)
    assert result(D.op5_decontamination(make_docs(DOCS), make_items(ITEMS))) == brute(DOCS, ITEMS)


def test_short_items_need_more_minima(make_docs, make_items):
    items = [i for i in ITEMS if i[0] not in (2,)]
    assert result(D.contaminated(make_docs(DOCS), make_items(items))) == brute(DOCS, items)
    assert D.load_of(1, 1e-6) < D.load_of(9, 1e-6) < D.load_of(30, 1e-6)
    p = (1 - 2.718281828459045 ** -D.load_of(9, 1e-6)) / D.load_of(9, 1e-6)
    assert 9 * log(1 - p) == pytest.approx(log(1e-6), rel=1e-6)


def test_minima_are_a_part_of_long_documents(spark, make_docs):
    df = D.with_shingles(make_docs([(1, LONG)]), "text")
    bits = D.bin_bits(D.F.size("__shingles"), 1.0)
    row = df.select("__shingles", D.minima(D.F.col("__shingles"), bits).alias("m"), bits.alias("b")).first()
    bins = {}
    for h in row["__shingles"]:
        bins.setdefault(h >> (64 - row["b"]), h)
        assert bins[h >> (64 - row["b"])] <= h
    assert row["m"] == sorted(bins.values()) and row["b"] == 15
    assert len(row["m"]) < 0.75 * len(row["__shingles"])


def test_empty_tables(make_docs, make_items):
    assert result(D.op5_decontamination(make_docs([]), make_items(ITEMS))) == {}
    assert result(D.op5_decontamination(make_docs(DOCS), make_items([]))) == {}
    assert result(D.op5_decontamination(make_docs(DOCS), make_items([(1, None)]))) == {}


def test_no_python_runs(make_docs, make_items):
    plan = D.op5_decontamination(make_docs(DOCS), make_items(ITEMS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
