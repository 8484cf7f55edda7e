"""Cross-entropy difference of matched n-gram models.

Two bigram models, of a target and of a background corpus, share one
vocabulary, order and smoothing.  The background counts are scaled to the
target's number of tokens, so that neither model is sharper only for having
seen more.  A document's score is the mean per-token difference of its losses
(target less background); low scores look like the target.

With c the (scaled) counts, N the tokens and V the vocabulary's size (one more
for words never seen): p(w) = (c(w) + 1) / (N + V) and
p(w | h) = (c(h, w) + A p(w)) / (c(h) + A).  A document's own counts are taken
out of the corpus it belongs to before it is scored.

All documents are counted, and every word and bigram of them.  Words and bigrams
go by 63 bits of a hash, whatever their length; two of a hundred million words
share a key with a probability of 1e-3.  The most frequent ones, bounded by a
parameter, are scored inside the document; a document's rarer ones meet their
counts in joins.  What was seen once in all has no counts left when its own
document is scored; a bit per hash tells most of it apart, which then needs no
join, and words seen once have no bigrams worth counting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislekit.llm._common import Scratch, frequency_class, frequency_cut

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
START, UNKNOWN = b"", b" "  # stand before a text's first word and for words outside a bounded vocabulary; no word is like them
SHIFT = 24  # inside a block of texts a bigram is its first id, shifted, and its second; so many bits hold an id
MASK = (1 << SHIFT) - 1
TEXTS = 256  # texts that are worked on together
BITS = 27  # a sieve has so many bits of a key as address
PLACE = 42  # the bits of a key above these say where to look for it among the held ones
PARTS = 3  # rarer bigrams meet their counts in so many rounds by their key, so that a part of them is in shuffles at a time
WORD_BYTES = 64  # longer words are outside a bounded vocabulary
#: So many target ids may be broadcast to mark documents; beyond, documents are shuffled.
BROADCAST_IDS = 2_000_000


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def key_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> 1


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Keys of bigrams from the keys of their words, which are evenly spread already."""
    mixed = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(1)).astype(np.int64)


class Encoder:
    """Bigrams of a block of texts by ids, and the keys of those ids.

    ``known``: sorted keys of a bounded vocabulary; without, all words are known.
    """

    def __init__(self, known: np.ndarray | None):
        self.known = known

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of words of each text, the bigrams of all texts one after another, and the keys."""
        words = list(map(words_of, texts))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        key = np.fromiter(map(xxhash.xxh64_intdigest, chain([START], chain.from_iterable(words))), np.uint64, 1 + sizes.sum())
        key, ids = np.unique((key >> np.uint64(1)).astype(np.int64), return_inverse=True)
        if self.known is not None:
            at = np.minimum(np.searchsorted(self.known, key), len(self.known) - 1)
            key, at = np.unique(np.where(self.known[at] == key, key, key_of(UNKNOWN)), return_inverse=True)
            ids = at[ids]
        first, second = ids[:-1].copy(), ids[1:]
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = ids[0]
        return sizes, first << SHIFT | second, key


class Head:
    """Counts, in both corpora, of the most frequent keys, and a sieve for the others.

    ``counts``: key, n_target, n_background, freq.  The sieve's size is fixed; it
    lets every key of ``counts`` pass, and the more of the rest the more there are.
    """

    def __init__(self, counts: DataFrame, most: int):
        frequent = frequency_class("freq") >= frequency_cut(counts, "freq", most)
        found = counts.where(frequent).select("key", "n_target", "n_background").toArrow()
        order = np.argsort(found.column(0).to_numpy())
        self.keys = np.r_[found.column(0).to_numpy()[order], np.iinfo(np.int64).max]  # a last row that nothing matches
        self.start = np.searchsorted(self.keys[:-1], np.arange(1 << 63 - PLACE) << PLACE).astype(np.int32)
        self.counts = [np.r_[found.column(i).to_numpy()[order], 0].astype(np.int64) for i in (1, 2)]
        at = F.shiftright(F.col("key").bitwiseAND((1 << BITS) - 1), 6).alias("at")
        bits = (counts.where(~frequent).groupBy(at)
                .agg(F.bit_or(F.expr("shiftleft(1L, CAST(key & 63 AS INT))")).alias("bits")).toArrow())
        self.sieve = np.zeros(1 << BITS - 6, np.int64)
        self.sieve[bits.column(0).to_numpy()] = bits.column(1).to_numpy()

    def find(self, key: np.ndarray) -> np.ndarray:
        """The place of the first held key that is not smaller; keys are evenly spread, so it is near its start."""
        at = self.start[key >> PLACE]
        low = np.flatnonzero(self.keys[at] < key)
        while len(low):
            at[low] += 1
            low = low[self.keys[at[low]] < key[low]]
        return at

    def __call__(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Whether each key is held, whether it may be a rarer one, and its counts (0 if not held)."""
        at = self.find(key)
        held = (self.keys[at] == key) & (at < len(self.keys) - 1)
        passes = self.sieve[(key & ((1 << BITS) - 1)) >> 6] >> (key & 63) & 1 == 1
        return held, ~held & passes, [np.where(held, c[at], 0) for c in self.counts]


def word_counts(docs: DataFrame, flush: int = 2_000_000) -> DataFrame:
    """Words of all texts: key, size (in bytes), n_target, n_background; START once for each text that has words.

    ``docs``: __target, __text.  A task sums up what it has seen before it sends.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def out() -> pa.RecordBatch:
            key, size, n = (np.concatenate(x) for x in zip(*held, strict=True)) if held else np.zeros((3, 0), np.uint64)
            held.clear()
            side = key & one == one
            key, first, at = np.unique(key >> one, return_index=True, return_inverse=True)
            sums = [np.bincount(at, weights=n * (side == k), minlength=len(key)).astype(np.int64) for k in (True, False)]
            return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(size[first].astype(np.int64)), *map(pa.array, sums)],
                                              names=["key", "size", "n_target", "n_background"])

        one = np.uint64(1)  # the last bit of a hash gives way to the corpus
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                words = [w and [START, *w] for w in map(words_of, part.column(1).to_pylist())]
                flat = list(chain.from_iterable(words))
                side = np.repeat(np.array(part.column(0).to_pylist(), dtype=np.uint64), list(map(len, words)))
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, flat), np.uint64, len(flat))
                key, at, n = np.unique(hashes & ~one | side, return_index=True, return_counts=True)
                held.append((key, np.fromiter((len(flat[k]) for k in at), np.int64, len(at)), n))
                n_held += len(key)
                if n_held > flush:
                    yield out()
                    n_held = 0
        yield out()

    sent = docs.mapInArrow(run, "key long, size long, n_target long, n_background long")
    return sent.groupBy("key").agg(F.first("size").alias("size"), F.sum("n_target").alias("n_target"),
                                   F.sum("n_background").alias("n_background"))


def bigram_counts(docs: DataFrame, shared_words, flush: int = 3_000_000) -> DataFrame:
    """Bigrams of all texts: key, n_target, n_background; summed up in tasks likewise.

    Some bigrams that are there once are left out, those of a word seen once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, head_words = shared_words.value
        encode, held, size = Encoder(known), [], 0

        def out() -> pa.RecordBatch:
            key, side, n = (np.concatenate(x) for x in zip(*held, strict=True)) if held else np.zeros((3, 0), np.int64)
            held.clear()
            key, at = np.unique(key, return_inverse=True)
            sums = [np.bincount(at, weights=n * (side == k), minlength=len(key)).astype(np.int64) for k in (1, 0)]
            return pa.RecordBatch.from_arrays([pa.array(key), *map(pa.array, sums)], names=["key", "n_target", "n_background"])

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                n_tokens, every, key = encode(part.column(1).to_pylist())
                side = np.repeat(np.array(part.column(0).to_pylist(), dtype=np.int64), n_tokens)
                is_word, may_be_word, _ = head_words(key)
                again = is_word | may_be_word
                again = again[every >> SHIFT] & again[every & MASK]
                found, n = np.unique((every << 1 | side)[again], return_counts=True)
                held.append((bigram_keys(key[found >> SHIFT + 1], key[found >> 1 & MASK]), found & 1, n))
                size += len(n)
                if size > flush:
                    yield out()
                    size = 0
        yield out()

    sent = docs.mapInArrow(run, "key long, n_target long, n_background long")
    return sent.groupBy("key").agg(F.sum("n_target").alias("n_target"), F.sum("n_background").alias("n_background"))


def marked(docs: DataFrame, target_ids: DataFrame, id_col: str, text: str) -> DataFrame:
    """__id, __target, __text of each document."""
    ids = target_ids.select(F.col(target_ids.columns[0]).alias("__t")).where("__t is not null").distinct()
    ids = ids.withColumn("__target", F.lit(True))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    return rows.join(ids, F.col("__id") == F.col("__t"), "left").select(
        "__id", F.coalesce("__target", F.lit(False)).alias("__target"), "__text")


def bounded(words: DataFrame, most: int) -> tuple[DataFrame, np.ndarray]:
    """Words with all but the most frequent ones as one, UNKNOWN, and the sorted keys of those that stay."""
    start = F.col("key") == key_of(START)
    short = words.where(~start & (F.col("size") <= WORD_BYTES))
    cut = frequency_cut(short, "freq", most)
    stays = start | ((F.col("size") <= WORD_BYTES) & (frequency_class("freq") >= cut))
    merged = (words.withColumn("key", F.when(stays, F.col("key")).otherwise(key_of(UNKNOWN))).groupBy("key")
              .agg(*(F.sum(c).alias(c) for c in ("n_target", "n_background", "freq"))))
    return merged, np.sort(words.where(stays).select("key").toArrow().column(0).to_numpy())


def score(docs: DataFrame, target_ids: DataFrame, vocabulary: int | None = None, head: int = 1_000_000,
          strength: float = 20.0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id_col, n_tokens, target_loss, background_loss, score.

    Documents whose id is in the first column of ``target_ids`` are the target
    corpus, all others the background.  Words are split at white space, A-Z
    lower-cased.  Texts without words have 0 tokens and null losses and score.
    The vocabulary is every word of the documents, or if ``vocabulary`` is given,
    so many of the most frequent at most, with one UNKNOWN word for the others.
    Counts of ``head`` words and of ``head`` bigrams go to every task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm-scoring")
    docs = marked(docs, target_ids, id_col, text)
    texts = docs.select("__target", "__text")
    freq = F.col("n_target") + F.col("n_background")

    words, known = scratch.table(word_counts(texts), "words").withColumn("freq", freq), None
    t = words.where(F.col("key") != key_of(START)).agg(F.sum("n_target"), F.sum("n_background"), F.count("key")).first()
    totals, n_words = (t[0] or 0, t[1] or 0), t[2]
    if vocabulary is not None:
        words, known = bounded(words, vocabulary)
        n_words = len(known) - 1 if len(known) else 0  # START is no word
        known = np.union1d(known, [key_of(START)])
    words = words.where(F.col("freq") > 1)
    shared_words = spark.sparkContext.broadcast((known, Head(words, head)))
    scale = (1.0, max(totals[0], 1) / max(totals[1], 1))

    pairs = scratch.table(bigram_counts(texts, shared_words).where(freq > 1), "bigrams").withColumn("freq", freq)
    shared_pairs = spark.sparkContext.broadcast(Head(pairs, head))
    words, pairs = words.drop("freq", "size"), pairs.drop("freq")

    fields = {"rare": "key:long,own:int,target_word:long,background_word:long",
              "rare_words": "word:long,pair:long,own:int,own_word:int", "rare_firsts": "key:long,own:int"}
    rarer = [f"{name}_{k}" for k in range(PARTS) for name in fields]

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, head_words), head_pairs = shared_words.value, shared_pairs.value
        encode = Encoder(known)

        def lists(of: np.ndarray, n: int, **fields: np.ndarray) -> pa.ListArray:
            """Structs of ``fields`` for each of n texts; ``of``: the text of each."""
            made = pa.StructArray.from_arrays([pa.array(x) for x in fields.values()], names=list(fields))
            return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=n))], pa.int32()), made)

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                target = np.array(part.column(1).to_pylist(), dtype=bool)
                n_tokens, grams, key = encode(part.column(2).to_pylist())
                rows = len(n_tokens)
                every = np.repeat(np.arange(rows), n_tokens) << 2 * SHIFT | grams
                both, own = np.unique(every, return_counts=True)
                d, w, pair = both >> 2 * SHIFT, both & MASK, bigram_keys(key[both >> SHIFT & MASK], key[both & MASK])
                _, of_word = np.unique(d << SHIFT | w, return_inverse=True)
                own_word = np.bincount(of_word, own)[of_word].astype(np.int64)
                first, at = np.unique(both >> SHIFT, return_index=True)
                own_first = np.add.reduceat(own, at) if len(at) else own
                first_d, first_h = first >> SHIFT, first & MASK
                _, rare_word, in_words = head_words(key)
                _, rare_pair, in_pairs = head_pairs(pair)
                u = rare_word[w]
                s, r = ~u & ~rare_pair, ~u & rare_pair
                f, g = ~rare_word[first_h], rare_word[first_h]
                sums, others = [], []
                for k in (0, 1):
                    mine = target if k == 0 else ~target
                    others.append(np.maximum(in_words[k][w] - mine[d] * own_word, 0))
                    p = (others[k] * scale[k] + 1) / ((totals[k] - mine * n_tokens) * scale[k] + n_words + 1)[d]
                    n = np.maximum(in_pairs[k] - mine[d] * own, 0) * scale[k]
                    h = np.maximum(in_words[k][first_h] - mine[first_d] * own_first, 0) * scale[k]
                    sums.append((np.bincount(first_d[f], (own_first * np.log(h + strength))[f], rows)
                                 - np.bincount(d[s], (own * np.log(n + strength * p))[s], rows)).astype(np.float64))
                small = lambda x: x.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n_tokens), *map(pa.array, sums),
                     *chain.from_iterable(
                         (lists(d[r], rows, key=pair[r], own=small(own[r]), target_word=others[0][r], background_word=others[1][r]),
                          lists(d[u], rows, word=key[w[u]], pair=pair[u], own=small(own[u]), own_word=small(own_word[u])),
                          lists(first_d[g], rows, key=key[first_h[g]], own=small(own_first[g])))
                         for r, u, g in ((r & (pair % PARTS == k), u & (pair % PARTS == k), g & (key[first_h] % PARTS == k))
                                         for k in range(PARTS)))],
                    names=["__id", "__target", "n_tokens", "target_sum", "background_sum", *rarer])

    kind = docs.schema["__id"].dataType.simpleString()
    rows = scratch.table(docs.mapInArrow(
        inside, f"__id {kind}, __target boolean, n_tokens long, target_sum double, background_sum double, "
                + ", ".join(f"{name} array<struct<{fields[name.rsplit('_', 1)[0]]}>>" for name in rarer))
        .withColumn("__row", F.monotonically_increasing_id()), "rows")

    sides = ("target", F.col("__target")), ("background", ~F.col("__target"))

    def rest(k: int, own: str) -> Column:
        """Count in a corpus without the document's own."""
        side, mine = sides[k]
        return F.greatest(F.coalesce(f"n_{side}", F.lit(0)) - F.when(mine, F.col(own)).otherwise(0), F.lit(0)).cast("long")

    def smoothed(k: int) -> Column:
        side, mine = sides[k]
        tokens = F.lit(totals[k]) - F.when(mine, F.col("n_tokens")).otherwise(0)
        return strength * (F.col(f"{side}_word") * scale[k] + 1) / (tokens * scale[k] + (n_words + 1))

    def each(name: str) -> DataFrame:
        return rows.select("__row", "__target", "n_tokens", F.explode(name).alias("r")).select("__row", "__target", "n_tokens", "r.*")

    more = lambda k, x: (F.col("own") * F.log(x)).alias(f"{sides[k][0]}_more")
    sums = [F.sum(f"{side}_more").alias(f"{side}_more") for side, _ in sides]
    counts, words = pairs, words.hint("shuffle_hash")

    def tail(part: int) -> DataFrame:
        """What the rarer words and bigrams of a part add to the sums of the rows."""
        pairs = counts.where(F.col("key") % PARTS == part).hint("shuffle_hash")
        of_words = each(f"rare_words_{part}").withColumnRenamed("word", "key").join(words, "key", "left").select(
            "__row", "__target", "n_tokens", F.col("pair").alias("key"), "own",
            *(rest(k, "own_word").alias(f"{sides[k][0]}_word") for k in (0, 1)))
        of_pairs = each(f"rare_{part}").unionByName(of_words).join(pairs, "key", "left").select(
            "__row", *(more(k, 1 / (rest(k, "own") * scale[k] + smoothed(k))) for k in (0, 1)))
        of_firsts = each(f"rare_firsts_{part}").join(words, "key", "left").select(
            "__row", *(more(k, rest(k, "own") * scale[k] + strength) for k in (0, 1)))
        return scratch.table(of_pairs.unionByName(of_firsts).groupBy("__row").agg(*sums), f"tail-{part}")

    tails = reduce(DataFrame.unionByName, map(tail, range(PARTS))).groupBy("__row").agg(*sums)
    n = F.nullif("n_tokens", F.lit(0))
    loss = lambda x: (F.col(f"{x}_sum") + F.coalesce(f"{x}_more", F.lit(0.0))) / n
    return (rows.drop(*rarer).join(tails, "__row", "left")
            .select(F.col("__id").alias(id_col), "n_tokens", loss("target").alias("target_loss"),
                    loss("background").alias("background_loss"))
            .withColumn("score", F.col("target_loss") - F.col("background_loss")))


def op1_lm_scoring(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; the target corpus is the documents labelled as of good quality."""
    return score(docs, labels.where("quality = 1").select("doc_id"))
