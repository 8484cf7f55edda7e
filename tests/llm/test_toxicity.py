"""Compression distance: scores, calibration, and held-out accuracy."""

import random
import zlib

import pytest

from aislekit.llm import toxicity as X

RUDE = ["idiot", "moron", "worthless", "pathetic", "scumbag"]


def text(rng, rude, n=80):
    words = ["".join(rng.choice(["th", "er", "on", "an", "re", "in"]) for _ in range(rng.randrange(1, 5))) for _ in range(n)]
    for _ in range(3 if rude else 0):
        words[rng.randrange(n)] = rng.choice(RUDE)
    return " ".join(words)


def corpus(n=900):
    rng = random.Random(1)
    return [(i, text(rng, i % 4 == 0), int(i % 4 == 0)) for i in range(n)]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1.0, 5) for i, t, _ in rows], "doc_id long, text string, score double, toxic int")
    labels = spark.createDataFrame([(i, 1, y, "x") for i, _, y in rows], "doc_id long, quality int, toxic int, text string")
    return docs, labels, rows


def test_held_out_accuracy(labelled):
    docs, labels, rows = labelled
    got = {r["doc_id"]: r for r in X.op7_toxicity(docs, labels).collect()}
    truth = {i: y for i, _, y in rows}
    assert set(got) == set(truth)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [i for i in got if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == truth[i] for i in held) / len(held) > 0.95


def test_only_training_rows_are_learnt(labelled, spark):
    docs, labels, rows = labelled
    sample, totals = X.labelled_sample(docs, labels, 50)
    got = sample.collect()
    assert len(got) == 100 and sum(r["y"] for r in got) == 50
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in got)
    assert totals[1] == sum(y for i, _, y in rows if zlib.crc32(str(i).encode()) % 5)


def test_odd_rows(labelled, make_docs):
    _, labels, rows = labelled
    odd = [(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, " \n "), (None, "idiot moron then " * 30), (5003, "x" * 300_000),
                                          (5004, "no label"), (5004, "no label"), (5005, "idiot " * 100_000)]
    got = X.op7_toxicity(make_docs(odd), labels).collect()
    assert len(got) == len(odd) and all(r["score"] is not None and r["held_out"] is not None for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[5000] == by[5001] == by[5002] < 0.5 < by[None]


@pytest.mark.parametrize("which", [[], [0], [1]])
def test_without_both_classes_nothing_is_toxic(spark, make_docs, which):
    labels = spark.createDataFrame([(i, y) for i in range(20) for y in which], "doc_id long, toxic int")
    got = X.op7_toxicity(make_docs([(i, "idiot") for i in range(20)]), labels).collect()
    assert {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)}
    assert X.op7_toxicity(make_docs([]), labels).collect() == []


def test_score_keeps_the_other_columns(make_docs):
    docs = make_docs([(1, "a"), (2, None)])
    out = X.score(docs, None, name="score")
    assert sorted(out.columns) == sorted(docs.columns) and {r["score"] for r in out.collect()} == {0.0}


def test_windows():
    assert X.windows(None) == X.windows("") == X.windows(" \t") == [X.CARRIER]
    assert X.windows("A b\nc") == [X.CARRIER + b" a b ", X.CARRIER + b" c "]
