"""Spelling variants against all pairs of words compared one by one."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aislekit.llm import spelling
from aislekit.llm._common import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(rows):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 2}


def is_near(a, b):
    """One insertion, deletion or replacement apart, letter by letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(n):
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and is_near(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def made(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_random_words(spark):
    rng = random.Random(3)
    n = {}
    for _ in range(1200):  # few letters, so that runs of equal letters and hot pairs are common
        w = "".join(rng.choice("abé") for _ in range(rng.choice([7, 7, 8, 8, 9])))
        n[w] = rng.choice([2, 2, 3, 3, 25, 30, 400, 5000, 60000])
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    assert made(spelling.group_variants(df)) == grouped(n)


def test_hand_made(spark):
    n = {"aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaaa": 200, "aaaaaaab": 20, "baaaaaa": 2, "zzzzzzz": 5,
         "x" * 3000: 2, "x" * 3001: 30, "ÿ" * 7: 4, "ÿ" * 6 + "z": 40}
    got = made(spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == grouped(n)
    by_word = {r[0]: r for r in got}
    assert by_word["aaaaaaa"][1:3] == ("aaaaaaaa", "aaaaaaaaa")  # a tie of n: the first in order; then on to the root


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_nodes_are_equal_just_where_prefixes_are(spark, partitions):
    rng = random.Random(partitions)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = spelling.number_nodes(df, F.col("word"), "nodes", Scratch(spark, "test"), starts=True).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    node_of = {}
    for r in rows:
        assert len(r["nodes"]) == len(r["word"]) + 1
        for i, node in enumerate(r["nodes"]):
            assert node_of.setdefault(r["word"][:i], node) == node
        assert r["starts"] == [i == 0 or r["word"][i] != r["word"][i - 1] for i in range(len(r["word"]))]
    assert len(set(node_of.values())) == len(node_of)
    ends = [r["nodes"][-1] for r in sorted(rows, key=lambda r: r["word"])]
    assert ends == sorted(ends)


def test_odd_documents(make_docs):
    rows = [(1, None), (2, ""), (3, "short words only"), (None, "Ungewöhnlich ungewöhnlich UNGEWÖHNLICH"),
            (4, "straßenbahn Straßenbahn strassenbahn strassenbahn"), (5, "received recieved received9received"),
            (5, "received recieved received9received"), (6, "received " * 40), (7, "a" * 5000 + " " + "a" * 5000),
            (8, "naïveté×÷naïveté naïveté×÷naïveté")]
    assert made(spelling.op13_spelling_variants(make_docs(rows))) == grouped(words_of(rows))


def test_empty_table(make_docs):
    assert spelling.op13_spelling_variants(make_docs([])).collect() == []


def test_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert made(spelling.op13_spelling_variants(documents)) == grouped(words_of(rows))
