"""Near-duplicate components against comparing all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from aislekit.llm import near_dup as N
from aislekit.llm._common import Scratch
from aislekit.llm._components import components


def brute(rows):
    """component_id per row, comparing all pairs of full sets."""
    sets = [N.shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= 75 * (len(a) + len(b) - n):
                    parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    out = Counter()
    for i, (d, _) in enumerate(rows):
        least = min((x for x in groups[find(i)] if x is not None), default=None) if sets[i] else d
        out[(d, len(sets[i]), least, d == least)] += 1
    return out


def text(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(n)]


def edited(rng, words, k):
    out = list(words)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**9)}"
    return out


def corpus():
    """Copies, edits on both sides of the threshold, chains, a shared passage, odd texts."""
    rng, rows = random.Random(3), []
    passage = text(rng, 60)
    for f in range(12):
        base = text(rng, rng.choice([20, 80, 300]))
        for k in range(6):
            rows.append(edited(rng, base, rng.randrange(0, 1 + len(base) // 25)))
    chain = text(rng, 200)
    for _ in range(10):
        rows.append(chain)
        chain = edited(rng, chain, 3)
    hot = text(rng, 60)
    rows += [edited(rng, hot, rng.choice([1, 2])) for _ in range(150)]
    for _ in range(120):
        rows.append(text(rng, rng.randrange(5, 60)) + passage + text(rng, rng.randrange(5, 60)))
    texts = [" ".join(r) for r in rows]
    texts += [None, "", " \t\n", "one", "ONE", "a b c d", "a  b c d ", "a b c d e", "É b c d e", "é b c d e",
              "long " * 40_000, "word" * 30_000]
    rng.shuffle(texts)
    out = [(i * 7, t) for i, t in enumerate(texts)]
    return out + [out[0], out[0], (out[1][0], "other text of the same id"), (None, out[3][1]), (None, "no id at all")]


@pytest.mark.parametrize("block", [4, 512])
def test_equals_all_pairs(make_docs, monkeypatch, block):
    monkeypatch.setattr(N.link_classes, "__defaults__", (block,))
    rows = corpus()
    got = Counter(map(tuple, N.op2_near_dup(make_docs(rows)).collect()))
    assert got == brute(rows)


def test_unlinked_near_copies_make_no_rows_of_pairs(make_docs, monkeypatch):
    """200 near copies at a similarity of about 0.71 are no links; their 19900 pairs are likely ones."""
    rng, base, rows = random.Random(5), [f"w{i}" for i in range(2000)], []
    for i in range(200):
        words = list(base)
        for at in rng.sample(range(2, 1998, 5), 35):
            words[at] = f"new{i}x{at}"
        rows.append((i, " ".join(words)))
    rows += [(1000, rows[3][1] + " end"), (1001, rows[7][1] + " end of it")]
    counts, confirmed = [], N.confirmed
    monkeypatch.setattr(N, "confirmed", lambda pairs, *a: counts.append(pairs.count()) or confirmed(pairs, *a))
    assert Counter(map(tuple, N.op2_near_dup(make_docs(rows)).collect())) == brute(rows)
    assert counts[-1] <= len(rows)


def test_a_large_group_confirms_a_few_pairs_a_member(make_docs, monkeypatch):
    """300 linked near copies share a bucket with other leaders in almost every band; a few pairs each connect them."""
    rng, base = random.Random(6), [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(300)]
    counts, confirmed = [], N.confirmed
    monkeypatch.setattr(N, "confirmed", lambda pairs, *a: counts.append(pairs.count()) or confirmed(pairs, *a))
    got = N.op2_near_dup(make_docs(rows)).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == len(rows)
    assert sum(counts) <= 5 * len(rows)


@pytest.mark.parametrize("name", ["k_id", "k_text", "k_copies", "c", "d"])
def test_keep_one_with_clashing_names(spark, name):
    docs = spark.createDataFrame([(1, "a b c d e f", 5), (2, "a b c d e f", 6), (3, "x y", 7)], f"doc_id long, text string, {name} int")
    assert sorted(map(tuple, N.keep_one(docs).collect())) == [(1, "a b c d e f", 5), (3, "x y", 7)]


def test_without_broadcast(make_docs, monkeypatch):
    monkeypatch.setattr(N, "BROADCAST_KEYS", 0)
    rows = corpus()[:200]
    assert Counter(map(tuple, N.op2_near_dup(make_docs(rows)).collect())) == brute(rows)


def test_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert Counter(map(tuple, N.op2_near_dup(documents).collect())) == brute(rows)


def test_empty_tables(make_docs):
    assert N.op2_near_dup(make_docs([])).collect() == []
    assert [tuple(r) for r in N.op2_near_dup(make_docs([(1, None)])).collect()] == [(1, 0, 1, True)]
    assert N.keep_one(make_docs([])).collect() == []


def test_keep_one_leaves_one_row_of_a_component(make_docs):
    rows = corpus()
    docs = make_docs(rows)
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for _, n, c, _ in brute(rows) if n}
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    full = [d for d, t in got if N.words_of(t)]
    # one row per component, its smallest id; the component that has no id keeps its only row
    assert Counter(full) == Counter(want)
    assert Counter(d for d, t in got if not N.words_of(t)) == Counter(d for d, t in rows if not N.words_of(t))


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    ra, rb = N.registers(a), N.registers(b)
    assert (N.merge(ra, rb) == N.registers(np.union1d(a, b))).all()
    est = N.estimate(ra[None], rb[None], np.array([2000.0]), np.array([2000.0]))
    assert abs(est[0] - 1 / 3) < 0.12
    assert N.estimate(ra[None], ra[None], np.array([2000.0]), np.array([2000.0]))[0] == 1


def test_components_of_a_long_path(spark):
    n = 300
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)) + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges, Scratch(spark, "test"), "path").collect()}
    assert got == {**dict.fromkeys(range(n), 0), 1000: 1000, 1001: 1000}
