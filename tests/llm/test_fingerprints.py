"""Weighted sampling against the similarity it estimates, and the edited texts against a plain loop."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from aislekit.llm import fingerprints as P

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def generalised_jaccard(a, b):
    x, y = (Counter(WORD.findall(t.encode().lower())) for t in (a, b))
    words = set(x) | set(y)
    return sum(min(x[w], y[w]) for w in words) / sum(max(x[w], y[w]) for w in words) if words else 1.0


def by_hand(rows, samples):
    # Spark's xxhash64 (seed 42, signed) of the text orders rows of one id
    tie = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64) - (1 << 63)
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))
    s, out = P.Sampler(samples, cached=0), Counter()
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        changed = t[:len(t) - half] + following[:half]
        f, e, n = (s.fingerprint(x) for x in (t, changed, following))
        out[(i, len(t), hashlib.sha256(changed.encode()).hexdigest(), P.as_text(f), P.as_text(e), P.likeness(f, e),
             P.likeness(f, n))] += 1
    return out


ROWS = [(5, "é" * 5 + " 名前 🙂🙂"), (1, None), (2, ""), (-7, "a b c a b"), (9, "word " * 30_000), (9, "again"), (9, "again"),
        (None, "no id"), (12, "A B\tc"), (13, "a b c"), (10**12, " \n "), (14, "x")]


@pytest.mark.parametrize("range_rows", [1, 3, 8000])
def test_equals_a_plain_loop(make_docs, range_rows):
    got = P.fingerprints(make_docs(ROWS), samples=16, range_rows=range_rows)
    assert Counter(map(tuple, got.collect())) == by_hand(ROWS, 16)


@pytest.mark.parametrize("rows", [[], [(1, "only one")], [(1, None)]])
def test_small_tables(make_docs, rows):
    assert Counter(map(tuple, P.fingerprints(make_docs(rows), samples=16).collect())) == by_hand(rows, 16)


def test_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = P.fingerprints(documents, samples=16, range_rows=30)
    assert Counter(map(tuple, got.collect())) == by_hand(rows, 16)
    full = P.op9_fingerprints(documents).collect()
    text = dict(rows)
    by_text = {}
    for r in full:
        assert by_text.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]


def test_collision_rate_is_the_generalised_jaccard_similarity():
    rng, s = random.Random(5), P.Sampler(2048, cached=0)
    for share in (0.2, 0.6, 0.9):
        a = [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(400)]
        b = [w if rng.random() < share else "z" + str(rng.randrange(200)) for w in a]
        x, y = " ".join(a), " ".join(b)
        j = generalised_jaccard(x, y)
        assert abs(P.likeness(s.fingerprint(x), s.fingerprint(y)) - j) < 4.5 * (j * (1 - j) / 2048) ** 0.5
    assert P.likeness(s.fingerprint("a a a b"), s.fingerprint("b a A a")) == 1
    assert P.likeness(s.fingerprint(""), s.fingerprint("a")) == 0


def test_the_cache_changes_nothing():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(50)) for _ in range(30)]
    a, b = P.Sampler(32, cached=0), P.Sampler(32, cached=17)
    for t in texts + texts:
        assert (a.fingerprint(t) == b.fingerprint(t)).all()
    assert len(b.row) == 17


def test_words_of_near_texts_are_not_drawn_again():
    s = P.Sampler(8)
    for text in ("a b c b", "a b", "a c c"):  # fresh, then partly in the cache
        sample, held = s.sample(text)
        drawn, draw = [], s.draw
        s.draw = lambda words: drawn.extend(words) or draw(words)  # noqa: B023
        edited, nothing = s.sample(text + " z z", (held,))
        s.draw = draw
        assert set(drawn) <= {b"z"} and nothing is None and set(held[0]) == set(text.encode().split())
        assert (edited == P.Sampler(8, cached=0).fingerprint(text + " z z")).all() and (sample == P.Sampler(8).fingerprint(text)).all()


def test_of_equal_values_the_first_word_is_taken():
    s, plain = P.Sampler(8), P.Sampler(8)
    s.draw = lambda words: (np.zeros((4, len(words), 8), dtype=np.float32), plain.draw(words)[1])
    assert (s.fingerprint("x y z") == s.fingerprint("x q")).all() and (s.fingerprint("x y") == plain.fingerprint("x")).all()
