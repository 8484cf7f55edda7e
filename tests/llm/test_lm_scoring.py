"""Cross-entropy differences against a plain computation."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislekit.llm import lm_scoring as L
from aislekit.llm._common import Scratch


def plain(rows, target_ids, known, strength):
    """(id, n, target loss, background loss) with the words in ``known`` as vocabulary."""
    docs = [(i, i in target_ids and i is not None, [w if w in known else None for w in L.words_of(t)]) for i, t in rows]
    corpus = []
    for side in (True, False):
        uni, bi, first = Counter(), Counter(), Counter()
        for _, target, ws in docs:
            if target == side:
                uni.update(ws)
                bi.update(zip(["<s>", *ws], ws, strict=False))
                first.update(["<s>", *ws][:len(ws)])
        corpus.append((uni, bi, first, sum(uni.values())))
    # a word's count as a context includes its last place in a document
    for uni, _, first, _ in corpus:
        for w in uni:
            first[w] = uni[w]
    scale = (1.0, max(1, corpus[0][3]) / max(1, corpus[1][3]))
    out = []
    for i, target, ws in docs:
        pairs = list(zip(["<s>", *ws], ws, strict=False))
        own_bi, own_uni, own_first = Counter(pairs), Counter(ws), Counter(h for h, _ in pairs)
        loss = [0.0, 0.0]
        for k, (uni, bi, first, n) in enumerate(corpus):
            mine = (k == 0) == target
            for h, w in pairs:
                p = ((uni[w] - mine * own_uni[w]) * scale[k] + 1) / ((n - mine * len(ws)) * scale[k] + len(known) + 1)
                c = max(0, bi[h, w] - mine * own_bi[h, w]) * scale[k]
                f = max(0, first[h] - mine * own_first[h]) * scale[k]
                loss[k] -= math.log((c + strength * p) / (f + strength))
        out.append((i, len(ws), *(x / len(ws) if ws else None for x in loss)))
    return out


def corpus():
    rng, rows = random.Random(4), []
    for i in range(60):
        letters = "abcd" if i % 3 == 0 else "cdef"
        rows.append((i, " ".join(rng.choice(letters) * rng.choice([1, 1, 2, 3]) for _ in range(rng.randrange(1, 60)))))
    return rows + [(100, None), (101, ""), (102, " \n"), (3, rows[3][1]), (3, "other text"), (None, "a B c"), (103, "x" * 100),
                   (104, "a b " * 20_000), (105, "É é")]


@pytest.mark.parametrize(("vocabulary", "head"), [(10_000, 1_000_000), (10_000, 0), (12, 30), (0, 0)])
def test_equals_a_plain_computation(spark, make_docs, vocabulary, head):
    rows = corpus()
    targets = [i for i in range(60) if i % 3 == 0] + [101, 3]
    ids = spark.createDataFrame([(i,) for i in targets] + [(None,)], "target long")
    got = L.score(make_docs(rows), ids, vocabulary=vocabulary, head=head).collect()
    freq = Counter(w for _, t in rows for w in L.words_of(t) if len(w) <= 64)
    classes, known, total = Counter(math.floor(math.log2(n) * 8) for n in freq.values()), set(), 0
    for c in sorted(classes, reverse=True):
        total += classes[c]
        if total > vocabulary:
            break
        known |= {w for w, n in freq.items() if math.floor(math.log2(n) * 8) == c}
    want = plain(rows, set(targets), known, 20.0)
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert a[:2] == b[:2]
        if b[2] is None:
            assert a[2] is a[3] is a[4] is None
        else:
            assert a[2:4] == pytest.approx(b[2:], rel=1e-9) and a[4] == pytest.approx(b[2] - b[3], abs=1e-9)


@pytest.mark.parametrize("head", [1_000_000, 5_000, 30, 0])
def test_every_word_counts_in_a_large_vocabulary(spark, make_docs, head):
    rows = corpus() + [(200 + i, " ".join(f"w{(i * 997 + k * (1 + i % 3)) % 24_000}" for k in range(4_000))) for i in range(15)]
    targets = [i for i in range(60) if i % 3 == 0] + [101, 3, 200, 203, 206, 209]
    ids = spark.createDataFrame([(i,) for i in targets], "target long")
    got = L.score(make_docs(rows), ids, head=head).collect()
    known = {w for _, t in rows for w in L.words_of(t)}
    assert len(known) > 16_000
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    for a, b in zip(sorted(map(tuple, got), key=order), sorted(plain(rows, set(targets), known, 20.0), key=order), strict=True):
        assert a[:2] == b[:2]
        assert a[2:4] == (pytest.approx(b[2:], rel=1e-9) if b[1] else (None, None))


def test_long_words_count_like_any_other(spark, make_docs):
    long = ["あ" * 30, "い" * 30, "う" * 30]  # 90 bytes each
    rows = [(i, " ".join([long[i % 2]] * 5 + [long[2]])) for i in range(8)]
    ids = spark.createDataFrame([(i,) for i in range(0, 8, 2)], "target long")
    want = plain(rows, set(range(0, 8, 2)), {w for _, t in rows for w in L.words_of(t)}, 20.0)
    for a, b in zip(sorted(map(tuple, L.score(make_docs(rows), ids).collect())), want, strict=True):
        assert a[:2] == b[:2] and a[2:4] == pytest.approx(b[2:], rel=1e-9)


def test_held_keys_are_found_wherever_they_lie():
    held = np.array([0, 1, 2, 5 << L.PLACE, (5 << L.PLACE) + 1, (1 << 63) - 2])  # three share a place
    head = L.Head.__new__(L.Head)
    head.keys = np.r_[held, np.iinfo(np.int64).max]
    head.start = np.searchsorted(held, np.arange(1 << 63 - L.PLACE) << L.PLACE).astype(np.int32)
    head.counts, head.sieve = [np.r_[np.arange(1, 7), 0]] * 2, np.zeros(1 << L.BITS - 6, np.int64)
    asked = np.r_[held, 3, (5 << L.PLACE) - 1, (1 << 63) - 1]
    found, rarer, counts = head(asked)
    assert found.tolist() == [True] * 6 + [False] * 3 and not rarer.any() and counts[0].tolist() == [1, 2, 3, 4, 5, 6, 0, 0, 0]


def test_written_steps_leave_no_shuffle_files(spark):
    scratch = Scratch(spark, "test")
    ids = lambda: set(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
                      .getAllFiles().mkString("\n").split("\n"))
    before = ids()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    got = scratch.table(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    deadline = time.time() + 20
    while (left := {f for f in ids() - before if "shuffle" in f}) and time.time() < deadline:
        time.sleep(0.2)
    assert not left and spark.conf.get(key) == setting
    assert sorted(r["count"] for r in got.collect()) == [142] * 1 + [143] * 6


def test_target_like_documents_score_lower(spark, make_docs):
    rows = corpus()
    ids = spark.createDataFrame([(i,) for i in range(0, 60, 6)], "target long")
    got = {r["doc_id"]: r["score"] for r in L.score(make_docs(rows[:60]), ids).collect()}
    like, unlike = [got[i] for i in range(3, 60, 6)], [got[i] for i in range(60) if i % 3]
    assert sum(like) / len(like) < sum(unlike) / len(unlike)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "target long")
    assert L.score(make_docs([]), none).collect() == []
    assert [tuple(r)[:2] for r in L.score(make_docs([(1, "a")]), none).collect()] == [(1, 1)]


def test_documents(documents, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = L.op1_lm_scoring(documents, labels).collect()
    assert len(got) == documents.count()
    assert all(r["score"] is not None and abs(r["score"]) < 20 for r in got if r["n_tokens"])
