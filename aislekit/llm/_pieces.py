"""Pre-tokens and pieces of byte-level BPE vocabularies, as the tokenizers library gives them."""

from __future__ import annotations

import json
import struct
import sys
import types

import public_tokenizers
import regex
from tokenizers import Tokenizer


class Known(dict):
    """Ids, packed, of the pre-tokens met lately; what isn't asked for again falls out."""

    def __init__(self, ids):
        super().__init__()
        self.ids, self.older = ids, {}

    def __missing__(self, pre_token: str) -> bytes:
        out = self.older.get(pre_token)
        if out is None:
            ids = self.ids(pre_token)
            out = struct.pack(f"<{len(ids)}I", *ids)
        self[pre_token] = out
        return out

    def age(self) -> None:
        self.older = dict(self)
        self.clear()


class BytePieces:
    """Ids of texts, encoding each different pre-token once while it stays in the cache.

    Only for files whose pre-tokenizer is ByteLevel with its regular
    expression and no prefix space; there a pre-token's ids do not depend on
    its neighbours.  Added tokens inside a text are found first, as the
    library does by default.
    """

    def __init__(self, path: str, cache: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if (pre.get("type"), pre.get("use_regex", True), pre.get("add_prefix_space")) != ("ByteLevel", True, False) \
                or spec["normalizer"] is not None:
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in their surroundings")
        self.added = added
        self.split_added = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) \
            if added else None
        self.findall = regex.compile(public_tokenizers.PATTERN).findall
        # the fixed byte alphabet of byte-level BPE: printable bytes stand for themselves, the rest follow from 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.limit, self.known = cache, Known(self.ids)

    def pre_tokens(self, text: str) -> tuple[list[str], list[str]]:
        """Pre-tokens of a text outside added tokens, and the added tokens in it."""
        if self.split_added is None or not self.split_added.search(text):
            return self.findall(text), []
        out = []
        for part in self.split_added.split(text):
            out += self.findall(part)
        return out, self.split_added.findall(text)

    def ids(self, pre_token: str) -> list[int]:
        """Ids of one pre-token."""
        word = pre_token.encode().decode("latin-1").translate(self.alphabet)
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        known = self.known
        if len(known) > self.limit:
            known.age()
        if self.split_added is None or not self.split_added.search(text):
            return b"".join(map(known.__getitem__, self.findall(text)))
        out, start = [], 0
        for m in self.split_added.finditer(text):
            out += map(known.__getitem__, self.findall(text[start:m.start()]))
            out.append(struct.pack("<I", self.added[m[0]]))
            start = m.end()
        out += map(known.__getitem__, self.findall(text[start:]))
        return b"".join(out)


def pieces(path: str) -> BytePieces:
    """One BytePieces per path and Python worker; it outlives a task."""
    kept = sys.modules.setdefault("_llm_worker_pieces", types.ModuleType("_llm_worker_pieces"))
    if path not in kept.__dict__:
        kept.__dict__[path] = BytePieces(path)
    return kept.__dict__[path]
