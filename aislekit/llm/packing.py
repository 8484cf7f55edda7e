"""Best-fit packing by exact-complement hashing.

How full a sequence gets depends on piece lengths alone, so the plan is made
from the histogram of lengths (at most ``capacity`` rows, whatever the
input).  Every length, longest first, looks up the single, pair or triple of
lengths that fills its gap exactly and consumes the combination as often as
the availability counts allow.  What has no exact complement goes best-fit
into the tightest open sequence.

The plan says, for each length, which rank of its pieces goes to which
sequence and offset; Spark ranks the pieces and applies it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislekit.llm._common import Scratch, gapless_rank
from aislekit.llm._pieces import pieces

SEPARATOR = 0


class SumIndex:
    """Lengths under availability counts; finds what adds up to a sum exactly."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in histogram.items():
            self.count[length] = n

    def single(self, total: int) -> tuple[int, ...] | None:
        return (total,) if total > 0 and self.count[total] > 0 else None

    def pair(self, total: int, most: int | None = None) -> tuple[int, ...] | None:
        """Two lengths with this sum, the larger one (at most ``most``) as large as can be."""
        hi = min(total - 1, most or total)
        lo = -(-total // 2)
        if hi < lo:
            return None
        x = np.arange(hi, lo - 1, -1)
        fits = (self.count[x] > 0) & (self.count[total - x] > (x * 2 == total))
        at = int(fits.argmax())
        return (int(x[at]), total - int(x[at])) if fits[at] else None

    def triple(self, total: int) -> tuple[int, ...] | None:
        """Three lengths with this sum, the largest one as large as can be."""
        first = np.flatnonzero(self.count[:max(0, total - 1)])[::-1]
        for x in first:
            x = int(x)
            if 3 * x < total:
                return None
            self.count[x] -= 1
            rest = self.pair(total - x, x)
            self.count[x] += 1
            if rest:
                return (x, *rest)
        return None

    def complement(self, gap: int) -> tuple[int, ...] | None:
        return self.single(gap) or self.pair(gap) or self.triple(gap)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ([(length, times), ...], number of sequences) that use every piece.

    Each step uses up a length, so there are at most a few patterns per
    length, not per piece.
    """
    index = SumIndex(histogram, capacity)
    count, done, left = index.count, [], Counter()
    for length in range(capacity, 0, -1):
        while count[length] > 0:
            gap = capacity - length
            count[length] -= 1  # the anchor itself
            rest = () if gap == 0 else index.complement(gap)
            count[length] += 1
            if rest is None:
                left[length], count[length] = int(count[length]), 0
                break
            need = Counter((length, *rest))
            times = min(int(count[x]) // k for x, k in need.items())
            for x, k in need.items():
                count[x] -= k * times
            done.append((sorted(need.items(), reverse=True), times))
    return done + best_fit(left, capacity)


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing over whole groups of equal pieces and equal open sequences."""
    open_by_gap: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}

    def put(gap: int, pattern: list[tuple[int, int]], n: int) -> None:
        if n:
            open_by_gap.setdefault(gap, []).append((pattern, n))

    for length in sorted(left, reverse=True):
        todo = left[length]
        for gap in sorted(g for g in open_by_gap if g >= length):
            fit = gap // length
            groups, open_by_gap[gap] = open_by_gap[gap], []
            for pattern, n in groups:
                full = min(n, todo // fit)
                put(gap - fit * length, [*pattern, (length, fit)], full)
                todo, n = todo - full * fit, n - full
                if n and todo:  # fewer than ``fit`` pieces are left: one more sequence takes them
                    put(gap - todo * length, [*pattern, (length, todo)], 1)
                    todo, n = 0, n - 1
                put(gap, pattern, n)
            if not todo:
                break
        fit = capacity // length
        put(capacity - fit * length, [(length, fit)], todo // fit)
        if todo % fit:
            put(capacity - todo % fit * length, [(length, todo % fit)], 1)
    return [g for groups in open_by_gap.values() for g in groups]


def placements(patterns: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first rank, times per sequence, first sequence, offset), sorted by the first two."""
    rows, used, sequence = [], Counter(), 0
    for pattern, n in patterns:
        offset = 0
        for length, times in pattern:
            rows.append((length, used[length], times, sequence, offset))
            used[length] += times * n
            offset += times * length
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def cut(docs: DataFrame, path: str, capacity: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of each document: id_col, piece, start, length, ids_crc32.

    A document is its ids and the separator; a longer one is cut into pieces
    of ``capacity``, of which the first may be shorter.  Null texts are empty:
    one piece, the separator.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, end = pieces(path), np.array([SEPARATOR], dtype="<u4").tobytes()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                row, number, start, length, crc = [], [], [], [], []
                for r, t in enumerate(part.column(1).to_pylist()):
                    ids = memoryview(p.encode(t or "") + end)
                    n = len(ids) // 4
                    at, k, i_piece = 0, n % capacity or capacity, 0
                    while at < n:
                        row.append(r)
                        number.append(i_piece)
                        start.append(at)
                        length.append(k)
                        crc.append(zlib.crc32(ids[4 * at:4 * (at + k)]))
                        at, k, i_piece = at + k, capacity, i_piece + 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=[id_col, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, capacity: int = 2048, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: what ``cut`` gives, and its sequence_id and offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    made = scratch.table(cut(docs, path, capacity, id_col, text)
                         .withColumn("__row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # at most `capacity` rows
    where = spark.sparkContext.broadcast(placements(plan(histogram, capacity)))
    ranked = gapless_rank(made, ["length"], [id_col, "piece", "__row"], sum(histogram.values()), out="__rank").drop("__row")
    columns = [id_col, "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = where.value
        key = at[:, 0] << 48 | at[:, 1]
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("__rank")).to_numpy()
            _, first, times, sequence, offset = at[np.searchsorted(key, length << 48 | rank, side="right") - 1].T
            j = rank - first
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in columns),
                 pa.array(sequence + j // np.maximum(times, 1)), pa.array(offset + j % np.maximum(times, 1) * length)],
                names=[*columns, "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.select(*columns, "__rank").mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op3_best_fit_packing(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(docs, path or public_tokenizers.path("byte_bpe_50k.json"))
