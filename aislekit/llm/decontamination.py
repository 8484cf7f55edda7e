"""Benchmark decontamination by size-partitioned MinHash containment search.

A benchmark item is short, a document may be very long, so the Jaccard
similarity of the two is tiny even if the document holds the whole item.
Documents are therefore partitioned by size (powers of two) and each
partition has a MinHash of its own fineness: its hash range is split into
bins, more for longer documents, and a signature is the smallest shingle hash
of every bin.  The bins of a partition are so many that an item whose
containment is at the threshold misses all of its shared shingles' minima
with a probability of at most ``miss``.

An item and a document that share a minimum are a candidate pair; candidates
are confirmed on the full shingle sets, which are sets of 64-bit hashes.

An item of one to four words has no shingle.  A document holds it where its
words stand consecutively: runs of as many words as there are such items of
are looked up themselves, word for word.

DataFrame functions only; a document's hashes stay in its row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislekit.llm._common import Scratch, words

WORDS = 5
#: So many item minima (24 bytes each) may be broadcast to the scan of the documents; beyond, both sides are shuffled.
BROADCAST_MINIMA = 1_000_000
#: So many candidate ids may be broadcast to fetch the candidates' texts.
BROADCAST_IDS = 1_000_000


def shingle_hashes(w: str) -> Column:
    """Distinct 64-bit hashes of the 5-word shingles of an array of words, sorted.

    With fewer words the whole sequence is one shingle; without words there
    is none.
    """
    def at(i, k):
        return F.get(w, i + k)

    long = F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: F.xxhash64(*(at(i, k) for k in range(WORDS))))
    short = F.array(F.xxhash64(F.array_join(w, " "), F.size(w)))
    return F.when(F.size(w) >= WORDS, F.sort_array(F.array_distinct(long))).when(F.size(w) > 0, short)


def with_shingles(df: DataFrame, text: str) -> DataFrame:
    """``df`` with __shingles (null without words) instead of the text.

    Don't filter on the result: the filter would be pushed below and hash the text twice.
    """
    split = df.withColumn("__words", words(text, F.lower)).drop(text)
    return split.withColumn("__shingles", shingle_hashes("__words")).drop("__words")


def load_of(shared: int, miss: float) -> float:
    """Shingles per bin at which ``shared`` common shingles are all hidden by smaller ones with probability ``miss``.

    A shingle is its bin's minimum with probability (1 - exp(-x)) / x at x
    shingles per bin.
    """
    need = 1 - miss ** (1 / max(1, shared))
    lo, hi = 1e-9, 64.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (1 - math.exp(-mid)) / mid >= need else (lo, mid)
    return lo


def bin_bits(n: Column, load: float) -> Column:
    """Bits of a bin number in the size partition of a set of ``n``: bins = upper size / load, rounded up."""
    size_class = F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double")))
    return F.least(F.lit(62), F.greatest(F.lit(0), size_class + math.ceil(-math.log2(load)))).cast("int")


def minima(hashes: Column, bits: Column) -> Column:
    """The smallest hash of every bin; a bin is the top bits, so in sorted order it is where the bin changes."""
    bin_of = lambda x: F.call_function("shiftright", x, 64 - bits)
    return F.filter(hashes, lambda x, i: (i == 0) | (bits > 0) & (bin_of(x) != bin_of(F.get(hashes, i - 1))))


def candidates(docs: DataFrame, items: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (__doc, __item) that share a minimum.  ``items``: __item, __shingles, __n; ``docs``: __doc, __shingles."""
    least = items.agg(F.min("__n")).first()[0]
    if least is None:
        least = 1
    load = load_of(math.ceil(threshold * least), miss)
    # all of an item's shingles are looked up, so a pair is found wherever a shared one is its bin's minimum
    own = items.select("__item", F.explode("__shingles").alias("__min"))
    sized = docs.withColumn("__bits", bin_bits(F.size("__shingles"), load))
    found = sized.select("__doc", F.explode(minima(F.col("__shingles"), F.col("__bits"))).alias("__min"))
    if own.count() <= BROADCAST_MINIMA:
        own = F.broadcast(own)
    return found.join(own, "__min").select("__doc", "__item").distinct()


def short_pairs(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs (__doc, __item) of items of one to four words that stand in a document, word for word.

    ``rows``: __doc, __text; ``items``: __item, __text.  Documents are only cut
    for the lengths that such items have.
    """
    short = (items.withColumn("__words", words("__text", F.lower)).withColumn("__k", F.size("__words"))
             .where(F.col("__k").between(1, WORDS - 1)).select("__item", "__k", F.array_join("__words", " ").alias("__run")))
    lengths = sorted(r[0] for r in short.select("__k").distinct().collect())  # at most four
    cut = rows.select("__doc", words("__text", F.lower).alias("__words"))

    def runs_of(k: int) -> DataFrame:
        runs = F.transform(F.sequence(F.lit(1), F.size("__words") - k + 1), lambda i: F.array_join(F.slice("__words", i, k), " "))
        some = F.when(F.size("__words") >= k, F.array_distinct(runs))
        return cut.select("__doc", F.lit(k).alias("__k"), F.explode(some).alias("__run"))

    runs = [runs_of(k) for k in lengths]
    if not runs:
        kinds = T.StructType([rows.schema["__doc"], items.schema["__item"]])
        return rows.sparkSession.createDataFrame([], kinds)
    found = runs[0]
    for r in runs[1:]:
        found = found.union(r)
    if short.count() <= BROADCAST_MINIMA:
        short = F.broadcast(short)
    return found.join(short, ["__k", "__run"]).select("__doc", "__item").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, miss: float = 1e-6,
                 id_col: str = "doc_id", text: str = "text", item_col: str = "item_id") -> DataFrame:
    """Pairs: id_col, item_col, n_item (item's shingles), n_shared, containment >= ``threshold``.

    Words are lower-cased and split at white space.  Null and blank texts are in
    no pair.  An item of fewer than five words is one shingle, and in every
    document that holds its words consecutively.  Rows that share an id (or
    have none) are one document: a pair is there if one of them holds the
    item; n_shared is the most any holds.
    """
    scratch = Scratch(docs.sparkSession, "decontamination")
    given = benchmark.select(F.col(item_col).alias("__item"), F.col(text).alias("__text"))
    enough = F.size(words("__text", F.lower)) >= WORDS
    items = scratch.table(with_shingles(given.withColumn("__enough", enough), "__text"), "items")
    items = items.where("__enough").withColumn("__n", F.size("__shingles"))
    rows = docs.select(F.col(id_col).alias("__doc"), F.col(text).alias("__text"))
    few = short_pairs(rows, given).select(F.col("__doc").alias(id_col), F.col("__item").alias(item_col), F.lit(1).cast("long").alias("n_item"),
                                          F.lit(1).cast("long").alias("n_shared"))
    pairs = scratch.table(candidates(with_shingles(rows, "__text"), items, threshold, miss), "candidates")
    ids = pairs.select("__doc").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    same = F.col("r.__doc").eqNullSafe(F.col("i.__doc"))
    texts = with_shingles(rows.alias("r").join(ids.alias("i"), same, "left_semi"), "__text")
    p, t = pairs.alias("p"), texts.alias("t")
    both = (p.join(t, F.col("p.__doc").eqNullSafe(F.col("t.__doc")))
            .join(items.alias("b"), F.col("p.__item").eqNullSafe(F.col("b.__item"))))
    shared = F.size(F.array_intersect("t.__shingles", "b.__shingles"))
    return (both.select(F.col("p.__doc").alias(id_col), F.col("p.__item").alias(item_col),
                        F.col("b.__n").cast("long").alias("n_item"), shared.cast("long").alias("n_shared"))
            .where(F.col("n_shared") >= threshold * F.col("n_item"))
            .groupBy(id_col, item_col, "n_item").agg(F.max("n_shared").alias("n_shared")).union(few)
            .withColumn("containment", F.round(F.col("n_shared") / F.col("n_item"), 6)))


def op5_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document and benchmark item that it holds: doc_id, item_id, n_item, n_shared, containment."""
    return contaminated(docs, benchmark)


ORACLE_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id,
         list_filter(string_split_regex(lower(text),
                                        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT 'b', item_id,
         list_filter(string_split_regex(lower(text),
                                        '[\x20\x09-\x0D]+'), lambda x: x <> '')
  FROM benchmark WHERE text IS NOT NULL
), s AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(words) >= 5
         THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
         WHEN kind = 'b' THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
  FROM w WHERE len(words) > 0
  UNION
  SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS shingle
  FROM w, (SELECT DISTINCT len(words) AS k FROM w WHERE kind = 'b' AND len(words) BETWEEN 1 AND 4) WHERE kind = 'd' AND len(words) >= k
), items AS (
  SELECT id AS item_id, shingle, count(*) OVER (PARTITION BY id) AS n_item FROM s WHERE kind = 'b'
)
SELECT s.id AS doc_id, item_id, n_item, count(*) AS n_shared, round(count(*) / n_item, 6) AS containment
FROM s JOIN items USING (shingle) WHERE s.kind = 'd'
GROUP BY s.id, item_id, n_item HAVING count(*) >= 0.75 * n_item
"""
