"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual`` points of a ring; a key goes to the shard of the
next point clockwise, and past shards that are already full.  Keys take their
turn by a hash of the id, so the outcome is that of placing them one by one,
whatever the partitioning.

Placing is not sequential, though.  A key's shard depends on its arc of the
ring (fixed) and on which shards are full at its turn; each shard fills once.
Histograms over (arc, turn) give those few moments, narrowed down to the
exact key inside the one slice of turns where a shard fills.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislekit.llm._common import Scratch, gapless_rank

TURN = ["__p1", "__p2", "__row"]  # the order in which keys are placed
BITS = 8  # turns are narrowed down by so many bits at a time


class Ring:
    """Points of all shards; for each arc the order in which its keys try the shards."""

    def __init__(self, shards: int, virtual: int):
        points = sorted((xxhash.xxh64_intdigest(f"shard {s}, point {v}") - (1 << 63), s)
                        for s in range(shards) for v in range(virtual))
        self.shards = shards
        self.at = np.array([p for p, _ in points], dtype=np.int64)
        owner = np.array([s for _, s in points])
        # how far each point is from the next point of every shard, walking backwards twice round the ring
        ahead, self.tries = np.zeros(shards, dtype=np.int64), np.empty((len(points), shards), dtype=np.int64)
        for i in range(2 * len(points) - 1, -1, -1):
            ahead += 1
            ahead[owner[i % len(points)]] = 0
            if i < len(points):
                self.tries[i] = np.argsort(ahead, kind="stable")

    def arc(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, position) % len(self.at)

    def target(self, full: np.ndarray) -> np.ndarray:
        """The shard of each arc's keys while the shards in ``full`` take none."""
        free = ~full[self.tries]
        return self.tries[np.arange(len(self.tries)), free.argmax(axis=1)]


def capacities(rows: int, shards: int, slack: float) -> np.ndarray:
    """Most rows of each shard; without slack the shards' counts are at most one apart."""
    if slack:
        return np.full(shards, int(np.ceil((1 + slack) * rows / shards)), dtype=np.int64)
    return rows // shards + (np.arange(shards) < rows % shards).astype(np.int64)


def fill_times(keys: DataFrame, ring: Ring, capacity: np.ndarray, exact_rows: int = 50_000):
    """When shards fill: [(last turn before, shards that are full after it)], and the first state.

    ``keys`` has __arc and the TURN columns.  A histogram brings at most arcs
    x 2**BITS counts to the driver; a slice of turns is listed key by key only
    once it holds at most ``exact_rows``.
    """
    load, full = np.zeros(ring.shards, dtype=np.int64), capacity <= 0
    start, events = full.copy(), []

    def add(arcs: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.bincount(ring.target(full)[arcs], weights=n, minlength=ring.shards).astype(np.int64)

    def one_by_one(part: DataFrame) -> None:
        nonlocal load, full
        got = part.select("__arc", *TURN).toArrow()
        arc, *turn = (got.column(i).to_numpy() for i in range(4))
        target = ring.target(full)
        for i in np.lexsort(turn[::-1]):
            s = target[arc[i]]
            load[s] += 1
            if load[s] == capacity[s]:
                full = full.copy()
                full[s] = True
                events.append((tuple(int(t[i]) for t in turn), full))
                if full.all():
                    return
                target = ring.target(full)

    def narrow(part: DataFrame, column: int, shift: int) -> None:
        """Place the keys of ``part`` slice by slice of the next bits of their turn."""
        nonlocal load, full
        name = TURN[column]
        digit = F.shiftright(name, shift) if shift == 64 - BITS else F.shiftright(name, shift).bitwiseAND(2 ** BITS - 1)
        hist = part.groupBy("__arc", digit.alias("d")).count().toArrow()
        arcs, d, n = (hist.column(i).to_numpy() for i in range(3))
        for x in np.unique(d):
            if full.all():
                return
            here = d == x
            more = add(arcs[here], n[here])
            if (load + more < capacity)[more > 0].all():
                load = load + more
                continue
            inside = part.where(digit == int(x))
            if n[here].sum() <= exact_rows:
                one_by_one(inside)
            elif shift:
                narrow(inside, column, shift - BITS)
            else:
                narrow(inside, column + 1, 64 - BITS)

    narrow(keys, 0, 64 - BITS)
    return start, events


def ring_keys(docs: DataFrame, ring: Ring, id_col: str) -> DataFrame:
    """``docs`` with each row's arc and turn.

    Rows of one id share an arc; they take their turns by a row id, which is
    frozen when the result is written.
    """
    spec = ring

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arc = spec.arc(batch.column(batch.schema.get_field_index("__at")).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(arc, pa.int64())],
                                             names=[*batch.schema.names, "__arc"])

    rows = (docs.withColumn("__row", F.monotonically_increasing_id())
            .withColumn("__at", F.xxhash64(F.lit("position"), id_col))
            .withColumn("__p1", F.xxhash64(F.lit("turn"), id_col))
            .withColumn("__p2", F.xxhash64(F.lit("turn"), "__row")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", __arc long"
    return rows.mapInArrow(run, schema).drop("__at")


def assign(keys: DataFrame, ring: Ring, start: np.ndarray, events) -> DataFrame:
    """``keys`` with ``shard``: looked up by arc and number of shards already full."""
    targets = np.array([ring.target(f) if not f.all() else ring.tries[:, 0] for f in (start, *(f for _, f in events))])
    turns = [t for t, _ in events]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, c, arc = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in (*TURN, "__arc"))
            epoch = np.zeros(len(a), dtype=np.int64)
            for x, y, z in turns:
                epoch += (a > x) | ((a == x) & ((b > y) | ((b == y) & (c > z))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(targets[epoch, arc], pa.int32())],
                                             names=[*batch.schema.names, "shard"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema) + ", shard int"
    return keys.mapInArrow(run, schema)


def shard(rows: DataFrame, shards: int, virtual: int = 64, slack: float = 0.0, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in the shard).

    ``slack``: a shard takes at most (1 + slack) times the mean count.  With
    0 the counts are at most one apart; with more, fewer rows move when a
    shard joins.  Null ids share one place on the ring like any other id.
    """
    scratch = Scratch(rows.sparkSession, "sharding")
    ring = Ring(shards, virtual)
    keys = scratch.table(ring_keys(rows, ring, id_col), "keys")
    n = keys.count()
    start, events = fill_times(keys, ring, capacities(n, shards, slack))
    placed = assign(keys, ring, start, events).drop("__arc", "__p1", "__p2")
    return gapless_rank(placed, ["shard"], [id_col, "__row"], n, out="slot").drop("__row")


def op8_sharding(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: shard counts are at most one apart.  Null texts have
    no bytes (size 1).
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard(rows, shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                      F.lit(None).cast("int").alias("grown_shard"))
