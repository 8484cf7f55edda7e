"""Token counts without materialising ids.

Pieces are counted once per distinct pre-token of the corpus; documents are
reduced to pre-token frequencies, which meet those counts in a join.

Frequent pre-tokens make up most of all occurrences.  Their counts (at most
``head`` of them, each at most ``HEAD_BYTES`` long, so a proven bound) go to
every task and are summed inside the document; only frequencies of the rarer
pre-tokens are shuffled to the join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislekit.llm._common import Scratch, frequency_class, frequency_cut
from aislekit.llm._pieces import pieces

HEAD_BYTES = 32


def frequencies(docs: DataFrame, path: str, text: str = "text", flush: int = 300_000) -> DataFrame:
    """Distinct pre-tokens of all texts with their frequency: pre_token, freq."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, seen = pieces(path), Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({"pre_token": pa.array(list(seen), pa.string()),
                                               "freq": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return made

        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                for t in batch.column(0).slice(i, 128).to_pylist():
                    if t:
                        seen.update(p.pre_tokens(t)[0])
                if len(seen) > flush:
                    yield out()
        yield out()

    return (docs.select(text).mapInArrow(run, "pre_token string, freq long")
            .groupBy("pre_token").agg(F.sum("freq").alias("freq")))


def piece_counts(vocabulary: DataFrame, path: str) -> DataFrame:
    """``vocabulary`` (pre_token, freq) with the number of pieces of each pre-token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for batch in batches:
            n = [len(p.ids(x)) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int32())],
                                             names=["pre_token", "freq", "n_pieces"])

    return vocabulary.select("pre_token", "freq").mapInArrow(run, "pre_token string, freq long, n_pieces int")


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", head: int = 200_000) -> DataFrame:
    """Per row of ``docs``: id_col, n_bytes, n_tokens.

    Null texts count as empty (0 bytes, 0 tokens).  Rows stay apart when ids
    repeat or are null.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-counts")
    docs = docs.select(F.col(id_col).alias("__id"), F.coalesce(text, F.lit("")).alias("__text"))
    counts = scratch.table(piece_counts(frequencies(docs, path, "__text"), path), "pieces")
    short = F.octet_length("pre_token") <= HEAD_BYTES
    is_head = short & (frequency_class("freq") >= frequency_cut(counts.where(short), "freq", head))
    known = counts.where(is_head).select("pre_token", "n_pieces").toArrow()
    shared = spark.sparkContext.broadcast(
        dict(zip(known.column(0).to_pylist(), known.column(1).to_pylist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, head_of = pieces(path), shared.value.get
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                n_bytes, n_head, names, times, ends = [], [], [], [], [0]
                for t in part.column(1).to_pylist():
                    found, added = p.pre_tokens(t)
                    total = len(added)
                    rare: dict[str, int] = {}
                    for x in found:
                        n = head_of(x)
                        if n is None:
                            rare[x] = rare.get(x, 0) + 1
                        else:
                            total += n
                    names += rare.keys()
                    times += rare.values()
                    ends.append(len(names))
                    n_bytes.append(len(t.encode()))
                    n_head.append(total)
                pairs = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(times, pa.int32())],
                                                   names=["pre_token", "n"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_head, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                    names=["__id", "n_bytes", "n_head", "rare"])

    schema = "__id " + docs.schema["__id"].dataType.simpleString() + \
        ", n_bytes long, n_head long, rare array<struct<pre_token:string,n:int>>"
    rows = scratch.table(docs.mapInArrow(run, schema).withColumn("__row", F.monotonically_increasing_id()), "documents")
    rare = (rows.select("__row", F.explode("rare").alias("r")).select("__row", "r.pre_token", "r.n")
            .join(counts.where(~is_head).select("pre_token", "n_pieces"), "pre_token")
            .groupBy("__row").agg(F.sum(F.col("n").cast("long") * F.col("n_pieces")).alias("n_rare")))
    return (rows.drop("rare").join(rare, "__row", "left")
            .select(F.col("__id").alias(id_col), "n_bytes",
                    (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_tokens")))


def op10_token_counts(docs: DataFrame, limit: int = 512, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
