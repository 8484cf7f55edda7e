"""Document fingerprints by consistent weighted sampling.

A text is a set of words weighted by their counts.  For every sample each
word draws r and c from Gamma(2, 1) and b from [0, 1), from its hash alone;
with t = floor(ln(weight) / r + b) the word with the smallest
ln(c) - r (t - b + 1) is taken together with its t.  Two texts take the same
sample with the probability of their generalised Jaccard similarity (sum of
smaller weights over sum of larger ones).
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislekit.llm._common import small_batches

FIRST = -(1 << 63)
#: Ids are dealt into ranges of about so many rows, at most MOST_RANGES of them.
RANGE_ROWS, MOST_RANGES = 16_000, 20_000


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers."""
    moved = x >> np.uint64(30)
    x = x ^ moved
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=moved)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=moved)
    return x


class Sampler:
    """Fingerprints with ``samples`` samples of 16 bits each.

    Draws of words seen at least twice stay in a cache of bounded size; they
    depend on the word alone, so the cache changes no result.
    """

    #: -ln of 16-bit uniform numbers; the sum of two entries has distribution Gamma(2, 1).
    EXPONENTIAL = (-np.log((np.arange(65536) + 0.5) / 65536)).astype(np.float32)

    def __init__(self, samples: int = 128, cached: int = 1 << 17):
        self.samples, self.cached = samples, cached
        self.seeds = mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.row: dict[bytes, int] = {}
        self.once: set[bytes] = set()
        self.draws, self.hashes = np.empty((4, 1024, samples), dtype=np.float32), np.empty(1024, dtype=np.uint64)

    def draw(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Value for weight 1, r, ln c and b of each word: 4 x words x samples; and the words' hashes."""
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        x = mix(hashes[:, None] ^ self.seeds)
        part = self.EXPONENTIAL.take(x.view(np.uint16), mode="clip").reshape(len(words), self.samples, 4)
        out = np.empty((4, len(words), self.samples), dtype=np.float32)
        np.add(part[:, :, 0], part[:, :, 1], out=out[1])
        np.log(part[:, :, 2] + part[:, :, 3], out=out[2])
        x *= np.uint64(0xD1342543DE82EF95)
        np.multiply((x >> np.uint64(41)).astype(np.uint32), np.float32(2.0 ** -23), out=out[3], casting="unsafe")
        out[0] = out[2] - out[1] * (1 - out[3])  # the logarithm of weight 1 is 0, and so is t
        return out, hashes

    def remember(self, words: list[bytes], made: np.ndarray, hashes: np.ndarray) -> None:
        """Cache the draws of words that were seen before."""
        free = self.cached - len(self.row)
        if free <= 0:
            return
        again = [k for k, w in enumerate(words) if w in self.once][:free]
        if again:
            at = len(self.row)
            while at + len(again) > self.draws.shape[1]:
                self.draws = np.concatenate([self.draws, np.empty_like(self.draws)], axis=1)
                self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
            self.draws[:, at:at + len(again)], self.hashes[at:at + len(again)] = made[:, again], hashes[again]
            self.row.update(zip((words[k] for k in again), range(at, at + len(again)), strict=True))
        if len(self.once) > 1_000_000:
            self.once.clear()
        self.once.update(words)

    def sample(self, text: str, near: tuple = ()) -> tuple[np.ndarray, tuple | None]:
        """Samples of a text (zeros without words, never zero otherwise) and where its words' draws are.

        Those are the words with their places in the cache (from 0) or, from -2 downwards, in the draws
        made for this text.  ``near``: such places of other texts, looked up first; then none are returned.
        """
        counts = Counter(text.encode().lower().split())  # the white space of bytes: \x20, \x09-\x0D
        if not counts:
            return np.zeros(self.samples, dtype=np.uint16), ({}, (self.draws[:, :0], self.hashes[:0]))
        words, n = list(counts), len(counts)
        # where a word's draws are: in the cache, in those of a near text, or in its own
        rows, left, cached, places = np.full(n, -1), np.arange(n), [], []

        def look_up(known: dict) -> np.ndarray:
            return np.fromiter(map(known.get, map(words.__getitem__, left.tolist()), repeat(-1)), np.int64, len(left))

        for known, block in near:
            at = look_up(known)
            held, theirs = at >= 0, at < -1
            cached.append(left[held])
            places.append((left[theirs], block))
            rows[left] = np.where(theirs, -2 - at, at)
            left = left[at == -1]
        rows[left] = look_up(self.row)
        cached.append(left[rows[left] >= 0])
        places.insert(0, (np.sort(np.concatenate(cached)), (self.draws, self.hashes)))
        left = left[rows[left] < 0]
        fresh = [words[i] for i in left]
        made = self.draw(fresh) if fresh else (self.draws[:, :0], self.hashes[:0])
        rows[left] = np.arange(len(fresh))
        places.append((left, made))
        times = np.fromiter(counts.values(), np.int64, n)
        value, hashes = np.empty((n, self.samples), dtype=np.float32), np.empty(n, dtype=np.uint64)
        own_steps, steps, at = np.full(n, -1), [], 0  # words in the order of their places
        for which, (block, hashes_of) in places:
            if not len(which):
                continue
            mine, here = rows[which], value[at:at + len(which)]
            block[0].take(mine, axis=0, out=here, mode="clip")
            hashes_of.take(mine, out=hashes[at:at + len(which)], mode="clip")
            more = np.flatnonzero(times[which] > 1)
            if len(more):
                r, c, b = (block[k].take(mine[more], axis=0) for k in (1, 2, 3))
                t = np.log(times[which[more]]).astype(np.float32)[:, None] / r
                t += b
                np.floor(t, out=t)
                np.subtract(t, b, out=b)
                b += 1
                b *= r
                here[more] = np.subtract(c, b, out=c)  # c - r * (t - b + 1)
                own_steps[at + more] = np.arange(len(more)) + sum(map(len, steps))
                steps.append(t)
            at += len(which)
        pick = (value == value.min(axis=0)).argmax(axis=0)  # of equal values the first
        t, stepped = np.zeros(self.samples, dtype=np.int64), np.flatnonzero(own_steps[pick] >= 0)
        if len(stepped):
            t[stepped] = np.concatenate(steps)[own_steps[pick[stepped]], stepped]
        taken = (mix(hashes[pick] + mix(t.astype(np.uint64) + np.uint64(1))) % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
        if fresh:
            self.remember(fresh, *made)
        if near:
            return taken, None
        rows[left] = -2 - rows[left]
        return taken, (dict(zip(words, rows.tolist(), strict=True)), made)

    def fingerprint(self, text: str) -> np.ndarray:
        """Samples of a text."""
        return self.sample(text)[0]


def as_text(samples: np.ndarray) -> str:
    return samples.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: estimates the generalised Jaccard similarity."""
    return float((a == b).mean())


def edit(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by the first as many of the following text."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


def with_following(docs: DataFrame, id_col: str, text: str, range_rows: int, most_ranges: int) -> DataFrame:
    """Rows in ranges of ids, each range in order and followed by the first row of the next range.

    Columns __range, __late (1 for such a following row), __key, __tie, id,
    text.  Ranges are cut at existing ids, so a range's first row is known
    from the ids alone; the last range is followed by the very first row.
    """
    small_batches(docs.sparkSession)
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("__key"), F.col(id_col).alias("__id"),
                        F.coalesce(text, F.lit("")).alias("__text"))
    n = keyed.count()
    ranges = min(most_ranges, max(1, -(-n // range_rows)))
    cuts = [F.min("__key").alias("lo")]
    if ranges > 1:
        cuts.append(F.percentile_approx("__key", [i / ranges for i in range(1, ranges)], 10 * ranges).alias("at"))
    got = keyed.agg(*cuts).first()
    if got["lo"] is None:
        starts = np.array([FIRST], dtype=np.int64)
    else:
        starts = np.unique(np.array([got["lo"], *(got["at"] if ranges > 1 else ())], dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            own = np.searchsorted(starts, key, side="right") - 1
            first = np.flatnonzero(starts[own] == key)  # they also follow the range before
            rows = np.r_[np.arange(len(key)), first]
            to = np.r_[own, (own[first] - 1) % len(starts)]
            late = np.r_[np.zeros(len(key), np.int32), np.ones(len(first), np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(late, pa.int32()),
                                              *(c.take(pa.array(rows)) for c in batch.columns)],
                                             names=["__range", "__late", *batch.schema.names])

    schema = "__range int, __late int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema)
    return (keyed.mapInArrow(run, schema).withColumn("__tie", F.xxhash64("__text"))
            .repartitionById(len(starts), F.col("__range"))
            .sortWithinPartitions("__range", "__late", "__key", "__tie"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", samples: int = 128,
                 range_rows: int = RANGE_ROWS, most_ranges: int = MOST_RANGES) -> DataFrame:
    """Per row: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that of the next larger id (of rows with one id, by a
    hash of the text; a null id comes first); after the last comes the first.
    Null texts are empty; a text without words is like other such texts only.
    """
    ordered = with_following(docs, id_col, text, range_rows, most_ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, last = Sampler(samples), None
        names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                out = [[] for _ in names]
                for at, late, ident, t in zip(*(part.column(c).to_pylist() for c in ("__range", "__late", "__id", "__text")),
                                              strict=True):
                    if late and (last is None or last[0] != at):
                        continue  # a second row of the following id
                    samples_of, held = sampler.sample(t)
                    if last is not None and last[0] == at:
                        _, was, text_of, own, held_of = last
                        changed = edit(text_of, t)
                        edited, _ = sampler.sample(changed, (held_of, held))
                        row = (was, len(text_of), hashlib.sha256(changed.encode()).hexdigest(), as_text(own),
                               as_text(edited), likeness(own, edited), likeness(own, samples_of))
                        for column, x in zip(out, row, strict=True):
                            column.append(x)
                    last = None if late else (at, ident, t, samples_of, held)
                kinds = [batch.schema.field("__id").type, pa.int64(), pa.string(), pa.string(), pa.string(),
                         pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return ordered.mapInArrow(run, f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")


def op9_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return fingerprints(docs)
