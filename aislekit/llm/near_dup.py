"""Near-duplicate components with SetSketch registers.

A document's set of 5-word shingles is summarised by registers
1 - floor(log_b(smallest exponential hash)), cut to 16 bits: exponentially
spaced minima, whose maximum merges two sketches.  Equal register values in
all places of a band make two documents candidates; the registers that are
larger, smaller and equal give the likelihood of a Jaccard similarity, and
candidates whose best estimate is far below the threshold go.  The rest are
confirmed on the full sets.

Documents of equal words are one class and are compared once.  A bucket first
tests its members against one leader (another one in each band), a few of a
member's leaders before the others, and links contract to components.  Only members of different components are compared
further, a hot bucket in blocks: register by register inside tasks, and the
members that have likely pairs on their full sets, inside tasks too.  Only links
that connect components become rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislekit.llm._common import Scratch
from aislekit.llm._components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SIZE = 5
BANDS, ROWS = 48, 5
M = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65535
MIXER = np.uint64(0x9E3779B97F4A7C15)
#: One odd multiplier per register.
MULTIPLIERS = np.array([xxhash.xxh64_intdigest(f"register {i}") | 1 for i in range(M)], dtype=np.uint64)
#: Members of a bucket are compared in blocks of about so many.
BLOCK = 512
#: So many text keys (about 40 bytes each) may be broadcast to fetch candidates' texts.
BROADCAST_KEYS = 500_000


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())  # bytes: A-Z only


def shingle_set(text: str | None) -> set[tuple[bytes, ...]]:
    """Distinct shingles; the whole sequence with fewer words; empty without words."""
    w = words_of(text)
    if len(w) < SIZE:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(SIZE)), strict=False))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def shingle_hashes(w: list[bytes], known: WordHashes) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of a word sequence."""
    if len(w) < SIZE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), len(w))] if w else [], dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
    s = h[:len(h) - SIZE + 1].copy()
    for k in range(1, SIZE):
        s ^= s >> np.uint64(29)
        s *= MIXER
        s += h[k:len(h) - SIZE + 1 + k]
    for shift in (32, 29, 32):
        s ^= s >> np.uint64(shift)
        s *= MIXER
    return np.unique(s)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of 64-bit hashes."""
    least = np.full(M, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 256):
        np.minimum(least, (hashes[i:i + 256, None] * MULTIPLIERS).min(axis=0), out=least)
    # the smallest of uniform numbers becomes the smallest of exponential ones with rate RATE
    u = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    value = np.floor(1 - np.log(-np.log1p(-u) / RATE) / np.log(BASE))
    return np.clip(value, 0, TOP).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, steps: int = 200) -> np.ndarray:
    """Jaccard similarity of largest likelihood, for rows of registers and set sizes.

    With u, v the shares of the two sizes, a register of a is the larger one
    with probability p(u - v J), of b with p(v - u J).
    """
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.minimum(u / v, v / u) * np.linspace(0, 1, steps + 1)[None, :]
    p = lambda x: np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)
    x, y = p(u - v * j), p(v - u * j)
    like = more * np.log(x) + less * np.log(y) + same * np.log(np.clip(1 - x - y, 1e-12, 1))
    return np.take_along_axis(j, like.argmax(1)[:, None], 1)[:, 0]


def sketch(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (id, text): id, __text (hash), __class (of its words), n_shingles, __sketch (null without words)."""
    kind = docs.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                classes, sizes, sketches = [], [], []
                for t in part.column(1).to_pylist():
                    w = words_of(t)
                    h = shingle_hashes(w, known)
                    classes.append(hashlib.md5(b" ".join(w), usedforsecurity=False).digest())
                    sizes.append(len(h))
                    sketches.append(registers(h).tobytes() if len(h) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(sketches, pa.binary())], names=["__id", "__text", "__class", "n_shingles", "__sketch"])

    return docs.mapInArrow(run, f"__id {kind}, __text long, __class binary, n_shingles long, __sketch binary")


def keys_of(sketch: bytes) -> list[int]:
    """A 64-bit key for each band."""
    return [xxhash.xxh64_intdigest(sketch[i:i + 2 * ROWS], i) - (1 << 63) for i in range(0, 2 * M, 2 * ROWS)]


def band_keys(classes: DataFrame) -> DataFrame:
    """node, keys: a 64-bit key for each band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(map(keys_of, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["node", "keys"])

    return classes.select("node", "__sketch").mapInArrow(run, "node long, keys array<long>")


def least_estimate(threshold: float, sigmas: float = 5.0) -> float:
    """The estimate ``sigmas`` standard errors below the threshold."""
    return threshold - sigmas * (threshold * (1 - threshold) / M) ** 0.5


def likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose estimate is not far below the threshold."""
    least = least_estimate(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                rows = [np.frombuffer(b"".join(part.column(c).to_pylist()), "<u2").reshape(-1, M) for c in (2, 4)]
                sizes = [part.column(c).to_numpy().astype(np.float64) for c in (3, 5)]
                keep = pa.array(estimate(*rows, *sizes) >= least)
                yield part.select(["a", "b"]).filter(keep)

    c = classes.select("node", "__sketch", "n_shingles")
    x = c.toDF("a", "sa", "na")
    y = c.toDF("b", "sb", "nb")
    # a set under the threshold's share of the other one cannot reach it
    both = pairs.join(x, "a").join(y, "b").where(F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    return both.select("a", "b", "sa", "na", "sb", "nb").mapInArrow(run, "a long, b long")


def texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text: the text of each of ``nodes``; where rows repeat, so does the node."""
    keys = nodes.join(classes.select("node", "rep"), "node").select("node", "rep.__id", "rep.__text")
    small = keys.count() <= BROADCAST_KEYS
    k, d = (F.broadcast(keys) if small else keys).alias("k"), docs.toDF("__id", "text", "__text").alias("d")
    return (d.join(k, (F.col("k.__text") == F.col("d.__text")) & F.col("k.__id").eqNullSafe(F.col("d.__id")))
            .select("k.node", "d.text"))


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    percent = round(100 * threshold)
    texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                keep = []
                for a, x, y in zip(*(part.column(c).to_pylist() for c in ("a", "ta", "tb")), strict=True):
                    if a != last:
                        last, last_set = a, shingle_set(x)
                    other = shingle_set(y)
                    n = len(last_set & other)
                    keep.append(100 * n >= percent * (len(last_set) + len(other) - n))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # the join on a comes last, so that a leader's rows arrive one after another
    both = pairs.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def blocks_of(active: DataFrame, block: int) -> DataFrame:
    """Members of buckets dealt into groups: key, i, j, own, node, component.

    ``active``: key, node, component.  A bucket is dealt into blocks of
    about ``block`` members, and every two blocks (i, j) meet in a group of their
    own, so no task holds more than two blocks of a bucket.
    """
    size = (active.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
            .where("lo <> hi").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    return (active.join(size, "key").withColumn("own", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component"))


GROUPED = ["key", "i", "j", "own", "node", "component"]


class Group:
    """Members of two blocks of a bucket (rows: GROUPED, n_shingles, __sketch, ...)."""

    def __init__(self, rows: list[tuple]):
        self.key, self.i, self.j = rows[0][:3]
        self.own, self.node, self.comp, self.n = (np.array([r[k] for r in rows]) for k in (3, 4, 5, 6))
        self.sketches = [r[7] for r in rows]
        self.regs = np.frombuffer(b"".join(self.sketches), "<u2").reshape(-1, M)

    def likely(self, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
        """Places (k, others) of pairs that are likely near, of different components as ``comp`` says at the time.

        A pair is found in the first band it shares only.
        """
        least = least_estimate(threshold)
        for k in range(len(self.node) - 1):
            rest = slice(k + 1, None)
            to = np.flatnonzero((self.comp[rest] != self.comp[k]) & ((self.own[rest] != self.own[k]) | (self.i == self.j))
                                & (np.minimum(self.n[rest], self.n[k]) >= threshold * np.maximum(self.n[rest], self.n[k]))) + k + 1
            if len(to):
                same = self.regs[to] == self.regs[k]
                # equal registers estimate the similarity too; the likelihood is worked out where they are not far too few
                enough = same.mean(1) >= least - 0.1
                to, same = to[enough], same[enough]
            if len(to):
                first = same.reshape(-1, BANDS, ROWS).all(2).argmax(1)
                to = to[np.array(keys_of(self.sketches[k]))[first] == self.key]
            if len(to):
                mine = np.broadcast_to(self.regs[k], (len(to), M))
                to = to[estimate(mine, self.regs[to], np.full(len(to), float(self.n[k])), self.n[to].astype(float)) >= least]
            if len(to):
                yield k, to


def groups_in(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows one group (key, i, j) after another, each node once."""
    group: list[tuple] = []
    for r in rows:
        if group and group[0][:3] != r[:3]:
            yield group
            group = []
        if not group or group[-1][4] != r[4]:
            group.append(r)
    if group:
        yield group


def by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")


def likely_members(active: DataFrame, classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """The members of each group that have a likely pair there, with n_shingles and __sketch.  No pair becomes a row."""
    rows = by_group(blocks_of(active, block).join(classes.select("node", "n_shingles", "__sketch"), "node")
                    .select(*GROUPED, "n_shingles", "__sketch"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_in(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            near = np.zeros(len(group), bool)
            for k, to in Group(group).likely(threshold):
                near[k] = near[to] = True
            if near.any():
                kept = zip(*(group[k] for k in np.flatnonzero(near)), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(kept, kinds, strict=True)], names=names)

    names = [*GROUPED, "n_shingles", "__sketch"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return rows.mapInArrow(run, "key long, i int, j int, own int, node long, component long, n_shingles long, __sketch binary")


def group_links(members: DataFrame, classes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that connect the components within each group, found on full shingle sets.

    A group's texts come once each and are compared inside the task.  Links inside
    what earlier links of the group connect already are left out, so that a group has
    fewer links than members.
    """
    percent = round(100 * threshold)
    texts = texts_of(members.select("node").distinct(), classes, docs).dropDuplicates(["node"])
    rows = by_group(members.join(texts, "node").select(*GROUPED, "n_shingles", "__sketch", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()

        def hashed() -> Iterator[tuple]:
            """Rows with the hashes of their shingles for their text."""
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    yield *r[:-1], shingle_hashes(words_of(r[-1]), known)

        for rows in groups_in(hashed()):
            group, sets, found = Group(rows), [r[-1] for r in rows], []
            for k, to in group.likely(threshold):
                for t in to:
                    if group.comp[t] == group.comp[k]:
                        continue
                    at = np.searchsorted(sets[k], sets[t])
                    n = np.count_nonzero(sets[k][np.minimum(at, len(sets[k]) - 1)] == sets[t])
                    if 100 * n >= percent * (len(sets[k]) + len(sets[t]) - n):
                        found.append((max(group.node[k], group.node[t]), min(group.node[k], group.node[t])))
                        group.comp[group.comp == group.comp[t]] = group.comp[k]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([int(p[k]) for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def star_links(stars: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """Links (a, b) that connect what all confirmed pairs of ``stars`` (a, b: distinct) connect.

    A member of a large group has a pair with a leader in almost every band.  Four
    pairs a node, dealt by a hash, are confirmed first and connect most of a group;
    of the others only those between different components are left to confirm.
    """
    dealt = stars.withColumn("h", F.xxhash64("a", "b"))

    def ends(mine: str, other: str) -> DataFrame:
        """Two pairs of each node; aggregates, so that a leader's pairs are not gathered."""
        of = dealt.groupBy(mine).agg(*(f(F.struct("h", other)).alias(n) for f, n in ((F.min, "x"), (F.max, "y"))))
        return reduce(DataFrame.union, [of.select(*(mine if c == mine else F.col(f"{n}.{c}").alias(c) for c in ("a", "b")))
                                        for n in ("x", "y")])

    picked = scratch.table(ends("a", "b").union(ends("b", "a")).distinct(), "picked-stars")
    links = scratch.table(confirmed(picked, classes, docs, threshold), "picked-links")
    comp = components(links, scratch, "picked")
    rest = (stars.join(comp.toDF("a", "of_a"), "a", "left").join(comp.toDF("b", "of_b"), "b", "left")
            .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b").join(picked, ["a", "b"], "left_anti"))
    more = confirmed(scratch.table(rest, "rest-stars"), classes, docs, threshold)
    return links.union(scratch.table(more, "star-links"))


def link_classes(classes: DataFrame, docs: DataFrame, scratch: Scratch, threshold: float, block: int = BLOCK) -> DataFrame:
    """Components of linked classes: node, component (only nodes with links)."""
    keys = scratch.table(band_keys(classes.where("__sketch is not null")), "keys")
    members = keys.select(F.explode("keys").alias("key"), "node")
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"),
                                        F.min(F.struct(F.xxhash64("node", "key").alias("h"), "node")).alias("lead"))
    buckets = scratch.table(members.join(shared.where("n > 1").select("key", F.col("lead.node").alias("lead")), "key"), "buckets")
    stars = (buckets.where("node <> lead").select(F.least("node", "lead").alias("b"), F.greatest("node", "lead").alias("a"))
             .distinct())
    stars = scratch.table(stars, "stars")
    links = star_links(scratch.table(likely(stars, classes, threshold), "likely-stars"), classes, docs, scratch, threshold)
    comp = components(links, scratch, "first")
    # a bucket's leader has been compared with all of its members
    active = (buckets.where("node <> lead").select("key", "node").join(comp, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    near = scratch.table(likely_members(active, classes, threshold, block), "likely-members")
    rest = scratch.table(group_links(near, classes, docs, threshold), "group-links")
    more = scratch.table(confirmed(rest, classes, docs, threshold), "rest-links")
    return components(links.union(more), scratch, "all")


def components_of(docs: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: __id, __text (hash of the text), n_shingles, component_id, __component.

    Rows are linked if 100 * intersection >= 100 * threshold * union of their
    shingle sets.  Null, empty and blank texts have an empty set and are
    linked with nothing.  component_id is the smallest id of a component; a
    null id is never the smallest while there is another.
    """
    scratch = Scratch(docs.sparkSession, "near-dup")
    docs = docs.select(F.col(id_col).alias("__id"), text,
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("__text"))
    rows = scratch.table(sketch(docs), "rows")
    full = rows.where("n_shingles > 0")
    classes = (full.groupBy("__class").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__text")).alias("rep"),
                                           F.first("n_shingles").alias("n_shingles"), F.first("__sketch").alias("__sketch")))
    classes = scratch.table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    linked = link_classes(classes, docs, scratch, threshold)
    placed = (classes.select("node", "__class", F.col("rep.__id").alias("least"))
              .join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.select("__class", "component").join(least, "component")
    full = full.join(placed, "__class").select("__id", "__text", "n_shingles", "component_id",
                                               F.col("component").alias("__component"))
    empty = rows.where("n_shingles = 0").select("__id", "__text", "n_shingles", F.col("__id").alias("component_id"),
                                                F.lit(None).cast("long").alias("__component"))
    return full.union(empty)


def keep_one(docs: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every component: that of the smallest id (of the smallest text hash, if ids repeat).

    Rows without words are in no component and stay.
    """
    scratch = Scratch(docs.sparkSession, "near-dup-kept")
    found = components_of(docs, threshold, id_col, text)
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__text")).alias("rep")
    kept = (found.where("__component is not null").groupBy("__component").agg(first).select("rep.__id", "rep.__text")
            .union(found.where("__component is null").select("__id", "__text").distinct()))
    copies = found.where("__component is not null").groupBy("__id", "__text").agg((F.count(F.lit(1)) > 1).alias("copies"))
    k = scratch.table(kept.alias("k").join(
        copies.alias("c"), F.col("k.__id").eqNullSafe(F.col("c.__id")) & (F.col("k.__text") == F.col("c.__text")), "left")
        .select(F.col("k.__id").alias("__kept_id"), F.col("k.__text").alias("__kept_text"),
                F.coalesce("c.copies", F.lit(False)).alias("__kept_copies")), "kept")
    d = docs.withColumn("__kept_hash", F.xxhash64(F.coalesce(text, F.lit(""))))
    k_all = F.broadcast(k) if k.count() <= BROADCAST_KEYS else k
    on = F.col(id_col).eqNullSafe(F.col("__kept_id")) & (F.col("__kept_hash") == F.col("__kept_text"))
    once = d.join(k_all.where("not __kept_copies"), on, "left_semi")
    again = d.join(k_all.where("__kept_copies"), on, "left_semi").dropDuplicates([id_col, "__kept_hash"])
    return once.union(again).drop("__kept_hash")


def op2_near_dup(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    return components_of(docs).select(
        F.col("__id").alias("doc_id"), "n_shingles", "component_id",
        F.col("__id").eqNullSafe(F.col("component_id")).alias("kept"))
