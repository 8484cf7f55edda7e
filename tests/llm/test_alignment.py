"""Alignments against whole texts encoded by both libraries and compared token by token."""

import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from aislekit.llm import alignment
from aislekit.llm._common import Scratch

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [(1, None), (2, ""), (3, " "), (4, "a<|endoftext|>b <s> </s><unk> <0x41>"), (5, "x" * 3000),
       (6, "don't  we'll\t\tÉté ½ ² ٣   \x1c\x85 名前 🙂🙂 é"), (6, "same id"), (7, "twice"), (7, "twice"),
       (None, "no id"), (8, "word " * 2000), (9, "\n\n  \n end  "), (10, "a▁b"), (11, "the ▁ end"), (12, "nul\0 here"),
       (13, "﷽ ﬁ ｱ 　 ﻿ z"), (14, "  leading and trailing \n "), (15, "a \n b\r\n  c   d"),
       (16, "🙂 👩‍👩‍👧 " * 50), (17, "ünïcödé wörds ünïcödé"), (18, "名" * 500)]


@pytest.fixture(scope="module")
def tokens():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    with open(A, encoding="utf-8") as f:
        entry = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain}
    for i, x in enumerate(x for x in range(256) if x not in plain):
        byte[chr(256 + i)] = x

    def both(text):
        """(id, bytes) of A's and B's tokens of a whole text, or none."""
        if not text:
            return [], []
        ta = [(i, bytes(byte[c] for c in entry[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        tb = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            is_byte = len(p) == 6 and p.startswith("<0x")
            tb.append((i, bytes([int(p[3:5], 16)]) if is_byte else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (ta, tb) if b"".join(x for _, x in ta) == want == b"".join(x for _, x in tb) else ([], [])

    return both


def ends(ts):
    out, at = [], 0
    for _, x in ts:
        at += len(x)
        out.append(at)
    return out


def digest(ta, tb):
    """Groups as text, and the pairs of overlapping tokens, by walking both lists byte by byte."""
    ea, eb = ends(ta), ends(tb)
    groups, links, i, j, cur = [], [], 0, 0, ([], [])
    while i < len(ta):
        links.append((ta[i][0], tb[j][0]))
        a_end, b_end = ea[i], eb[j]
        if a_end <= b_end:
            cur[0].append(str(ta[i][0]))
            i += 1
        if b_end <= a_end:
            cur[1].append(str(tb[j][0]))
            j += 1
        if a_end == b_end:
            groups.append(",".join(cur[0]) + "|" + ",".join(cur[1]))
            cur = ([], [])
    return ";".join(groups), links


def expected(rows, tokens):
    made = [(i, tokens(t)) for i, t in rows]
    digests = [(i, ta, tb, *digest(ta, tb)) for i, (ta, tb) in made]
    docs = Counter(p for *_, links in digests for p in set(links))
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(top.get(a, 0), n)
    out = Counter()
    for i, ta, tb, groups, links in digests:
        out[(i, len(ta), len(tb), groups.count(";") + 1 if ta else 0, len(links),
             sum(docs[p] == top[p[0]] for p in links), sum(docs[p] for p in links),
             hashlib.sha256(groups.encode()).hexdigest() if ta else "")] += 1
    return out


def test_odd_texts(make_docs, tokens):
    got = Counter(map(tuple, alignment.op12_alignment(make_docs(ODD)).collect()))
    assert got == expected(ODD, tokens)


def test_documents(documents, tokens):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert Counter(map(tuple, alignment.op12_alignment(documents).collect())) == expected(rows, tokens)


@pytest.mark.parametrize("head", [0, 7])
def test_rare_pairs_meet_their_counts_in_the_join(make_docs, tokens, head, spark):
    df = alignment.aligned(make_docs(ODD), A, B)
    rows = Scratch(spark, "test").table(df.selectExpr("monotonically_increasing_id() AS row", "*"), "rows")
    scored = alignment.score_links(rows, alignment.pair_counts(rows, 32000), head=head)
    got = Counter((r["doc_id"], r["n_best"], r["count_sum"]) for r in scored.collect())
    want = Counter()
    for k, n in expected(ODD, tokens).items():
        want[(k[0], k[5], k[6])] += n
    assert got == want


def test_group_ends_are_common_byte_offsets(make_docs, tokens):
    rows = [(i, t) for i, t in ODD if i is not None]
    got = {(r["doc_id"], r["groups"]): r["group_ends"] for r in alignment.aligned(make_docs(rows), A, B, ends=True).collect()}
    for i, t in rows:
        ta, tb = tokens(t)
        assert got[i, digest(ta, tb)[0]] == sorted(set(ends(ta)) & set(ends(tb)))


@pytest.mark.parametrize("in_chunks", [True, False])
def test_any_mixture_of_characters(tokens, in_chunks):
    rng = random.Random(5)
    alphabet = [" ", "  ", "\n", "\t", " ", " ", "▁", "a", "the", "é", "名", "🙂", "1", "'s", ".", "\x00", "́"]
    al = alignment.Aligner(A, B, cache=50)  # a small cache that turns over
    assert al.in_chunks
    al.in_chunks = in_chunks
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    for i in range(0, len(texts), 64):
        for t, got in zip(texts[i:i + 64], al.align(texts[i:i + 64]), strict=True):
            ta, tb = tokens(t)
            assert b";".join(x[0] for x in got or []).decode() == digest(ta, tb)[0], repr(t)


def test_empty_table(make_docs):
    assert alignment.op12_alignment(make_docs([])).collect() == []
