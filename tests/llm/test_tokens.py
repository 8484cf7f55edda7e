"""Token counts and packing against the tokenizers library itself."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aislekit.llm import packing, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, None), (2, ""), (3, " "), (4, "a<|endoftext|>b <|endoftext|><|endoftext|>\n"), (5, "x" * 30_000),
       (6, "don't  we'll\t\tÉté ½ ² ٣   \x1c\x85 名前 🙂🙂 é"), (6, "same id"), (7, "twice"), (7, "twice"),
       (None, "no id"), (8, "word " * 9_000), (9, "\n\n  \n end  ")]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("head", [0, 5, 200_000])
def test_counts_equal_the_library_on_odd_texts(make_docs, library, head):
    got = token_counts.count_tokens(make_docs(ODD), PATH, head=head)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = Counter((i, len((t or "").encode()), len(ids(library, t))) for i, t in ODD)
    assert Counter(map(tuple, got.collect())) == want


def test_counts_equal_the_library_on_documents(documents, library):
    got = Counter(map(tuple, token_counts.op10_token_counts(documents).collect()))
    want = Counter()
    for r in documents.collect():
        n = len(ids(library, r["text"]))
        want[(r["doc_id"], len((r["text"] or "").encode()), n, n > 512)] += 1
    assert got == want


def test_every_code_point_splits_as_in_the_library(make_docs, library):
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    rows = [(i, " ".join(f"a{c}b {c}{c} {c}1" for c in chars[i:i + 512])) for i in range(0, len(chars), 512)]
    got = {r[0]: r[2] for r in token_counts.count_tokens(make_docs(rows), PATH).collect()}
    assert got == {i: len(ids(library, t)) for i, t in rows}


def test_empty_table(make_docs):
    assert token_counts.op10_token_counts(make_docs([])).collect() == []
    assert packing.op3_best_fit_packing(make_docs([])).collect() == []


def check_packing(rows, texts, library, capacity):
    """Pieces hold the documents' ids, and lie in their sequences without gap or overlap."""
    docs = defaultdict(list)
    for i, t in texts:
        docs[i].append([*ids(library, t), 0])
    made, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        made[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    want, have = Counter(), Counter()
    for i, all_ids in docs.items():
        for x in all_ids:
            at, k, piece = 0, len(x) % capacity or capacity, 0
            while at < len(x):
                crc = zlib.crc32(np.array(x[at:at + k], dtype="<u4").tobytes())
                want[(i, piece, at, k, crc)] += 1
                at, k, piece = at + k, capacity, piece + 1
    for r in rows:
        have[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
    assert have == want
    for rs in seqs.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(seqs), -(-sum(r["length"] for r in rows) // capacity)


@pytest.mark.parametrize("capacity", [8, 64, 2048])
def test_packing_of_odd_texts(make_docs, library, capacity):
    rows = packing.pack(make_docs(ODD), PATH, capacity).collect()
    used, least = check_packing(rows, ODD, library, capacity)
    assert used <= least + 1


def test_packing_of_documents(documents, library):
    rows = packing.op3_best_fit_packing(documents).collect()
    used, least = check_packing(rows, [(r["doc_id"], r["text"]) for r in documents.collect()], library, 2048)
    assert used <= least + 1


@pytest.mark.parametrize("histogram", [{}, {8: 3}, {5: 4}, {3: 7, 5: 7}, {1: 100, 7: 3}, {2: 5, 3: 1, 4: 9, 8: 1}])
def test_plan_uses_every_piece_once(histogram):
    patterns = packing.plan(histogram, 8)
    used = Counter()
    for pattern, n in patterns:
        assert sum(length * k for length, k in pattern) <= 8
        for length, k in pattern:
            used[length] += k * n
    assert used == Counter(histogram)


def test_triples_are_found():
    assert packing.SumIndex({2: 1, 5: 1, 6: 1}, 20).complement(13) == (6, 5, 2)
    assert packing.SumIndex({4: 2}, 20).complement(12) is None
    assert packing.SumIndex({4: 3}, 20).complement(12) == (4, 4, 4)
