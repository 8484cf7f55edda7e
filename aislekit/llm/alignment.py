"""Cross-tokenizer alignment: which tokens of a byte-level BPE cover which of a sentencepiece model.

Both libraries give spans: tokenizers the character offsets of its tokens,
sentencepiece the spans of its proto (what older releases call the immutable
proto).  They are coarse where a character of several bytes is cut: byte-level
tokens inside one character share its span, and pieces of byte fallback hold
no text but at the last byte.  Those ends are refined by the tokens' decoded
bytes; all others must agree with them, or the text has no tokens.

A text is cut before a space or line end that follows other than white space, and
between a letter and a comma, full stop or exclamation mark.  No token of
either kind reaches over such a place: the byte-level pattern splits there, and
no sentencepiece entry holds the two characters side by side, which is looked
up in the vocabulary.  So each different chunk is aligned once while it stays
in a bounded cache, many at a time; words between spaces are made of chunks and
kept as well, and a text's alignment is that of its words in turn.  A vocabulary that allows no cut makes the whole text one chunk.

Pair counts over the corpus go to tasks for the most frequent pairs (at most
``head``); rarer ones meet their count in a join.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from aislekit.llm._common import Scratch, frequency_class, frequency_cut

SPACE = "▁"
#: Chunks of at most so many characters are kept, and aligned together up to so many characters.
KEPT, TOGETHER = 64, 4_000
#: A word that any chunk may follow.
CARRIER = " a"
#: Marks before which a letter ends a chunk.
MARKS = ",.!"


class Aligner:
    """Alignments of texts; ``code`` of a pair of ids is a * n_b + b."""

    def __init__(self, path_a: str, path_b: str, ends: bool = False, cache: int = 300_000):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if (pre.get("type"), pre.get("use_regex", True), pre.get("add_prefix_space")) != ("ByteLevel", True, False) \
                or spec["normalizer"] is not None:
            raise ValueError(f"{path_a}: not a plain byte-level vocabulary")
        # the fixed byte alphabet of byte-level BPE: printable bytes stand for themselves, the rest follow from 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.n_a = self.a.get_vocab_size()
        self.bytes_a = [b""] * self.n_a
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.n_b = self.b.get_piece_size()
        self.is_byte = np.array([self.b.is_byte(i) for i in range(self.n_b)])
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.is_byte[i] else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        model = sentencepiece_model_pb2.ModelProto()
        with open(path_b, "rb") as f:
            model.ParseFromString(f.read())
        rule = model.normalizer_spec
        spelt = [p for i, p in enumerate(pieces) if not self.is_byte[i]]
        def never(pair: str) -> bool:
            return not any(re.search(pair, p) for p in spelt)

        self.in_chunks = (not rule.precompiled_charsmap and rule.add_dummy_prefix and not rule.remove_extra_whitespaces
                          and never(f"[^{SPACE}]{SPACE}") and model.trainer_spec.model_type == model.trainer_spec.BPE)
        marks = "".join(m for m in MARKS if never(rf"[^\W\d_]{re.escape(m)}"))
        cuts = rf"(?<=\S)(?=[ {chr(10) if never(chr(10)) else ''}])" + (rf"|(?<=[^\W\d_])(?=[{re.escape(marks)}])" if marks else "")

        self.len_a = np.array([len(x) for x in self.bytes_a])
        self.len_b = np.array([len(x) for x in self.bytes_b])
        name_a, name_b = ([b"%d" % i for i in range(n)] for n in (self.n_a, self.n_b))
        self.names = np.array([x + c for names, ends in ((name_a, b",|"), (name_b, b",;"))
                               for c in (ends[:1], ends[1:]) for x in names], dtype=object)
        self.marks = set(marks)
        self.split, self.loose = re.compile(cuts).split, re.compile(r"\s ").search
        # what is known of chunks and of words, recent and older; what isn't asked for twice falls out
        self.ends, self.cache, self.gens, self.word_gens = ends, cache, [{}, {}], [{}, {}]
        self.young, self.old = self.gens

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of both tokenizations of ``text``, which starts with a space; None if either loses bytes."""
        data = text.encode()
        got = self.a.encode(text, add_special_tokens=False)
        list_a, (from_a, to_a) = got.ids, zip(*got.offsets, strict=True)
        proto = self.b.encode(text[1:], return_type="proto").pieces
        list_b = [p.id for p in proto]
        if b"".join([self.bytes_a[i] for i in list_a]) != data or b"".join([self.bytes_b[i] for i in list_b]) != data:
            return None
        ids_a, from_a, to_a = (np.array(x, dtype=np.int64) for x in (list_a, from_a, to_a))
        ids_b, rough_b = np.array(list_b, dtype=np.int64), np.array([p.end for p in proto]) + 1
        exact_a, exact_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        if len(data) == len(text):
            rough_a = to_a
        else:
            chars = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            width = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
            rough_a = np.concatenate(([0], np.cumsum(width)))[to_a]
        shared = np.append(from_a[1:] < to_a[:-1], False)  # the next token lies in the same character
        ends_a = np.where(shared, exact_a, rough_a)
        ends_b = np.where(self.is_byte[ids_b], exact_b, rough_b)
        if not np.array_equal(ends_a, exact_a) or not np.array_equal(ends_b, exact_b):
            return None
        return ids_a, ends_a, ids_b, ends_b

    def learn(self, chunks: list[str], out: dict) -> None:
        """Alignments of ``chunks`` into ``out``: (groups, links, number of A tokens, group ends), or ().

        The first chunk starts with a space, and the others can follow each other.
        """
        text = "".join(chunks)
        got = self.spans(text)
        if got is None:
            if len(chunks) == 1:
                out[chunks[0]] = ()
            else:
                for c in chunks:
                    self.learn_alone(c, out)
            return
        ids_a, ends_a, ids_b, ends_b = got
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        # every stretch between two ends lies in one token of each kind: the links
        stretch = np.union1d(ends_a, ends_b)
        links = (ids_a[np.searchsorted(ends_a, stretch)] * self.n_b + ids_b[np.searchsorted(ends_b, stretch)])
        # names of the tokens in order: a group's A tokens, then its B tokens, each with the sign that follows it
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        first = 2 * self.n_a
        name = np.concatenate([ids_a + self.n_a * last_a, first + ids_b + self.n_b * last_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        names = self.names[name[order]].tolist()
        ends = np.cumsum([len(c.encode()) for c in chunks])
        at = [np.searchsorted(x, ends, side="right").tolist() for x in (stretch, ends_a, ends_b)]
        s = a = b = 0
        raw = links.astype("<i8").tobytes()
        for chunk, s1, a1, b1 in zip(chunks, *at, strict=True):
            out[chunk] = (b"".join(names[a + b:a1 + b1])[:-1], raw[8 * s:8 * s1], a1 - a)
            s, a, b = s1, a1, b1
        if self.ends:
            at, c, start = np.searchsorted(cuts, ends, side="right").tolist(), 0, 0
            for chunk, c1, end in zip(chunks, at, ends.tolist(), strict=True):
                out[chunk] += ((cuts[c:c1] - start).astype("<i8").tobytes(),)
                c, start = c1, end

    def learn_alone(self, chunk: str, out: dict) -> None:
        """Alignment of one chunk; where it doesn't start with a space it stands after a carrier that does."""
        if chunk[0] == " " or not self.in_chunks:
            self.learn([chunk], out)
        else:
            got: dict = {}
            text = self.spans(CARRIER + chunk)
            if text is not None:
                self.learn([CARRIER, chunk], got)
            out[chunk] = got.get(chunk, ())

    def words(self, text: str) -> list[str]:
        """``text`` cut before its spaces, but for those that follow white space or end it."""
        if not self.in_chunks:
            return [text]
        out = text.split(" ")
        if text[0] == " " or text[-1].isspace() or self.loose(text):
            made: list[str] = []
            for w in out:
                if made and (not made[-1] or made[-1][-1].isspace()):
                    made[-1] += " " + w
                else:
                    made.append(w)
            if len(made) > 1 and (not made[-1] or made[-1].isspace()):  # sentencepiece adds no space to an empty text
                made[-2:] = [made[-2] + " " + made[-1]]
            return made
        return out

    def chunks(self, word: str) -> list[str]:
        """Chunks of space + ``word``."""
        if word.isalpha() or not self.in_chunks:
            return [" " + word]
        if word[-1:] in self.marks and word[:-1].isalpha():
            return [" " + word[:-1], word[-1]]
        out = self.split(" " + word)
        if len(out) > 1 and out[-1].isspace():
            out[-2:] = [out[-2] + out[-1]]
        return out

    def learn_all(self, chunks: Iterable[str]) -> dict:
        """Aligns all given chunks; returns what isn't kept, the long ones."""
        young, old, out = self.young, self.old, {}
        together, size = [CARRIER], 0
        for c in chunks:
            got = young.get(c)
            if got is not None:
                continue
            got = old.get(c)
            if got is not None:
                young[c] = got
            elif self.in_chunks and not c[-1].isspace() and SPACE not in c and len(c) <= KEPT:
                if not c[0].isspace() and not together[-1][-1].isalpha():
                    together.append(CARRIER)  # a mark follows a letter
                together.append(c)
                size += len(c)
                if size > TOGETHER:
                    self.learn(together, young)
                    together, size = [CARRIER], 0
            else:
                self.learn_alone(c, out)
        if len(together) > 1:
            self.learn(together, young)
        return out

    def joined(self, parts: list[tuple], chunks: list[str]) -> tuple:
        """One alignment of the chunks of a word."""
        if () in parts:
            return ()
        out = (b";".join([x[0] for x in parts]), b"".join([x[1] for x in parts]), sum([x[2] for x in parts]))
        if self.ends:
            at, ends = 0, []
            for x, c in zip(parts, chunks, strict=True):
                ends.append(np.frombuffer(x[3], dtype="<i8") + at)
                at += len(c.encode())
            out += (np.concatenate(ends).tobytes(),)
        return out

    def align(self, texts: list[str | None]) -> list[list[tuple] | None]:
        """For each text the alignments of its words; None for texts without tokens."""
        for gen in (self.gens, self.word_gens):
            if len(gen[0]) > self.cache:
                gen[:] = [{}, gen[0]]
        self.young, self.old = self.gens
        known, before = self.word_gens
        out, holes = [], []  # holes: a text's list, a place in it, and the word that belongs there
        need: dict[str, list[str]] = {}
        for t in texts:
            words = self.words(t) if t else []
            got = list(map(known.get, words))
            out.append(got)
            if None in got:
                for i in [i for i, x in enumerate(got) if x is None]:
                    w = words[i]
                    old = before.get(w)
                    if old is not None:
                        got[i] = known[w] = old
                    else:
                        holes.append((got, i, w))
                        if w not in need:
                            need[w] = self.chunks(w)
        alone, young = self.learn_all(dict.fromkeys(c for chunks in need.values() for c in chunks)), self.young
        made = {}
        for w, chunks in need.items():
            parts = [alone[c] if c in alone else young[c] for c in chunks]
            made[w] = parts[0] if len(parts) == 1 else self.joined(parts, chunks)
            if len(w) <= KEPT:
                known[w] = made[w]
        for got, i, w in holes:
            got[i] = made[w]
        return [got if got and () not in got else None for got in out]


def aligner(path_a: str, path_b: str, ends: bool = False) -> Aligner:
    """One Aligner per pair of paths and Python worker; it outlives a task."""
    kept = sys.modules.setdefault("_llm_worker_aligners", types.ModuleType("_llm_worker_aligners")).__dict__
    if (path_a, path_b, ends) not in kept:
        kept[path_a, path_b, ends] = Aligner(path_a, path_b, ends)
    return kept[path_a, path_b, ends]


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text",
            ends: bool = False) -> DataFrame:
    """Per row of ``docs``: id_col, n_a, n_b, n_groups, n_links, groups, pairs, times, with ``ends`` also group_ends.

    ``groups`` names the tokens between common ends as "a1,a2|b1;a3|b2,b3";
    ``pairs`` are the distinct codes (a * number of B ids + b) of overlapping
    tokens and ``times`` how often each overlaps; ``group_ends`` are byte
    offsets in space + text.  Texts that are null, empty or not given back
    byte for byte have no tokens: zeros, "" and empty arrays.  Rows stay apart
    when ids repeat or are null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b, ends)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                counts, groups, codes, times, at, all_ends, ends_at = [], [], [], [], [0], [], [0]
                for got in al.align(part.column(1).to_pylist()):
                    if got is None:
                        counts.append((0, 0, 0, 0))
                        groups.append(b"")
                    else:
                        name = b";".join([x[0] for x in got])
                        links = np.frombuffer(b"".join([x[1] for x in got]), dtype="<i8")
                        n_a, n_groups = sum([x[2] for x in got]), name.count(b";") + 1
                        counts.append((n_a, len(links) + n_groups - n_a, n_groups, len(links)))
                        groups.append(name)
                        code, n = np.unique(links, return_counts=True)
                        codes.append(code)
                        times.append(n)
                        if ends:
                            start = 0
                            for x in got:
                                e = np.frombuffer(x[3], dtype="<i8") + start
                                all_ends.append(e)
                                start = e[-1]
                    at.append(at[-1] + (len(codes[-1]) if got else 0))
                    ends_at.append(ends_at[-1] + (counts[-1][2] if ends else 0))
                joined = lambda xs: np.concatenate(xs) if xs else np.array([], dtype=np.int64)
                cols = [part.column(0), *(pa.array(x, pa.int64()) for x in zip(*counts, strict=True)),
                        pa.array(groups, pa.binary()).cast(pa.string()),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(joined(codes), pa.int64())),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(joined(times), pa.int64()).cast(pa.int32()))]
                if ends:
                    cols.append(pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pa.array(joined(all_ends), pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    names = ["__id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times", *(["group_ends"] if ends else [])]
    schema = (f"__id {rows.schema['__id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
              "groups string, pairs array<long>, times array<int>" + (", group_ends array<long>" if ends else ""))
    return rows.mapInArrow(run, schema).withColumnRenamed("__id", id_col)


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """Of rows with ``pairs``: pair, docs (rows that hold it), best (the largest docs of its A id)."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    a = F.expr(f"pair div {n_b}")
    # one row per A id, so never more than the vocabulary
    top = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("best"))
    return counts.withColumn("a", a).join(top, "a").select("pair", "docs", (F.col("docs") == F.col("best")).alias("is_best"))


def score_links(rows: DataFrame, counts: DataFrame, head: int = 1_000_000) -> DataFrame:
    """``rows`` (row, pairs, times, ...) with n_best and count_sum over their links instead of pairs and times."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "alignment-scores")
    is_head = frequency_class("docs") >= frequency_cut(counts, "docs", head)
    known = counts.where(is_head).orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(tuple(known.column(c).to_numpy(zero_copy_only=False)
                                                for c in ("pair", "docs", "is_best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, docs, best = shared.value
        pair, docs, best = np.append(pair, np.iinfo(np.int64).max), np.append(docs, 0), np.append(best, False)
        for batch in batches:
            codes, lists = batch.column("pairs").flatten().to_numpy(), batch.column("pairs")
            times = batch.column("times").flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            at = np.searchsorted(pair, codes)
            here = pair[at] == codes
            sums = [_sums(row, w, batch.num_rows) for w in (times * (best[at] & here), times * np.where(here, docs[at], 0))]
            far = ~here
            ends = np.concatenate(([0], np.cumsum(_sums(row, far.astype(np.int64), batch.num_rows))))
            rare = pa.StructArray.from_arrays([pa.array(codes[far]), pa.array(times[far])], names=["pair", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)],
                names=["row", "head_best", "head_sum", "rare"])

    made = scratch.table(rows.select("row", "pairs", "times").mapInArrow(
        run, "row long, head_best long, head_sum long, rare array<struct<pair:long,n:long>>"), "head")
    rare = (made.select("row", F.inline("rare")).join(counts.where(~is_head), "pair")
            .groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("rare_best"),
                                F.sum(F.col("n") * F.col("docs")).alias("rare_sum")))
    scores = made.drop("rare").join(rare, "row", "left").select(
        "row", (F.col("head_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("head_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"))
    return rows.drop("pairs", "times").join(scores, "row")


def _sums(row: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums of ``weights`` by ``row``, which ascends."""
    total = np.concatenate(([0], np.cumsum(weights)))
    return total[np.searchsorted(row, np.arange(n), side="right")] - total[np.searchsorted(row, np.arange(n))]


def op12_alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that a tokenizer doesn't give back byte
    for byte, have zeros and an empty digest.  Repeated rows are documents of
    their own, in the counts as well.
    """
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    scratch = Scratch(docs.sparkSession, "alignment")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = scratch.table(aligned(docs, path_a, path_b).withColumn("groups_sha256", digest).drop("groups")
                         .withColumn("row", F.monotonically_increasing_id()), "rows")
    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = scratch.table(pair_counts(rows, n_b), "pairs")
    return score_links(rows, counts).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                            "groups_sha256")
