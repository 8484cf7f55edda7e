"""Spelling variants: exact neighbours at one edit through a dictionary of trie-node pairs.

Words are sorted, so that the nodes of their trie can be numbered while
walking through a partition: a word keeps the nodes of the prefix it shares
with the word before and gets new numbers for the rest.  What a partition
shares with the one before is settled from one boundary word a partition.
The reversed words give the nodes of suffixes the same way.

A word with its i-th character skipped is the pair (node of the prefix before
i, node of the suffix after i); a word itself, cut at i, is the pair of the
two nodes that meet there.  Two words that skip to the same pair differ by a
replacement; one that skips to a pair at which another is cut has a character
more.  Pairs are integers and exact, so nothing is verified afterwards.

A pair is met by at most one cut and by one skip per letter, so groups are
bounded by the alphabet whatever the input; frequent words are counted before
they meet anything.
"""

from __future__ import annotations

import os.path
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType

from aislekit.llm._common import Scratch, small_batches

# Fixed by the task: letters of a run, the shortest word, how many runs lose a letter.
LETTERS = r"A-Za-zÀ-ÿ"
SHORTEST, LEAST, ONE_IN, MUCH = 7, 2, 31, 10
#: Numbers of a partition's nodes lie below this bit, the partition above it.
NODE_BITS = 40


def spoilt_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shortest: int = SHORTEST,
                 one_in: int = ONE_IN) -> DataFrame:
    """One row (word) per run of letters with at least ``shortest`` letters left.

    A run loses one letter where the crc32 of "id:run" says so; a null id
    counts as the empty string, a null text as empty.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{shortest},}})"), 1)
    run = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    name = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    at = (F.col("h") % F.length("run")).cast("int")
    kept = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return (docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))
            .select("id", run.alias("run")).select("run", F.crc32(name.cast("binary")).alias("h"))
            .select(F.when(F.col("h") % one_in == 0, kept).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= shortest))


def vocabulary(words: DataFrame, least: int = LEAST) -> DataFrame:
    """Distinct words with their count, from ``least`` on: word, n."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def number_nodes(rows: DataFrame, key: Column, out: str, scratch: Scratch, starts: bool = False) -> DataFrame:
    """``rows`` with ``out``: the trie nodes of the key's prefixes, from the empty one to the whole key.

    Keys must be distinct.  Equal prefixes have equal numbers in all
    partitions, and whole keys ascend in code-point order.  With ``starts``
    a column tells for each letter whether it differs from the one before.
    """
    spark = rows.sparkSession
    names = rows.columns
    schema = rows.withColumn("__key", key).schema.add("__part", LongType()).add("__nodes", ArrayType(LongType()))
    if starts:
        schema = schema.add("starts", ArrayType(BooleanType()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, nodes, fresh = "", [0], 1
        for batch in batches:
            keys = batch.column("__key").to_pylist()
            flat, ends, differ = [], [0], []
            for k in keys:
                shared = len(os.path.commonprefix((before, k)))
                nodes = nodes[:shared + 1] + list(range(fresh, fresh + len(k) - shared))
                fresh += len(k) - shared
                before = k
                flat += nodes
                ends.append(len(flat))
                if starts:
                    differ.append([i == 0 or k[i - 1] != c for i, c in enumerate(k)])
            made = [*batch.columns, pa.array([part] * len(keys), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))]
            if starts:
                made.append(pa.array(differ, pa.list_(pa.bool_())))
            yield pa.RecordBatch.from_arrays(made, names=schema.names)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = scratch.table(rows.withColumn("__key", key).repartitionByRange(n, "__key").sortWithinPartitions("__key")
                          .mapInArrow(walk, schema), f"local-{out}")
    ends = (local.groupBy("__part").agg(F.min("__key").alias("first"), F.max("__key").alias("last"),
                                        F.max_by("__nodes", "__key").alias("nodes")).orderBy("__part").collect())
    carried, last, held = [], None, []  # one boundary word a partition, so as many rows as partitions
    for r in ends:
        carry = held[:len(os.path.commonprefix((last, r["first"]))) + 1] if held else [0]
        carried.append((r["__part"], carry))
        held = [carry[x] if x < len(carry) else (r["__part"] << NODE_BITS) + x for x in r["nodes"]]
        last = r["last"]
    carries = spark.createDataFrame(carried, "__part long, __carry array<long>")
    node = lambda x: F.when(x < F.size("__carry"), F.get("__carry", x.cast("int"))).otherwise(
        F.shiftleft("__part", NODE_BITS) + x)
    return (local.join(F.broadcast(carries), "__part")
            .select(*names, F.transform("__nodes", node).alias(out), *(["starts"] if starts else [])))


def neighbours(words: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Of distinct ``words`` (word, n): rows (id, word, n), and rows (id, n_near, best) of words with neighbours.

    ``best`` is (n, -id) of the neighbour with the largest n, at ties the
    first in code-point order.
    """
    there = number_nodes(words, F.col("word"), "fore", scratch, starts=True)
    both = scratch.table(number_nodes(there, F.reverse("word"), "back", scratch), "nodes")
    both = both.withColumn("id", F.element_at("fore", -1)).withColumn("len", F.size("starts"))
    # back[k] is the node of the last k letters
    skip = F.transform(F.sequence(F.lit(0), F.col("len") - 1), lambda i: F.struct(
        F.get("fore", i).alias("p"), F.get("back", F.col("len") - 1 - i).alias("s"), F.lit(True).alias("skip"),
        F.get("starts", i).alias("first")))
    cut = F.transform(F.sequence(F.lit(0), F.col("len")), lambda i: F.struct(
        F.get("fore", i).alias("p"), F.get("back", F.col("len") - i).alias("s"), F.lit(False).alias("skip"),
        F.lit(False).alias("first")))
    pairs = both.select("id", "n", F.inline(F.concat(skip, cut)))

    # in a pair: skips by falling n, then the word that is cut there; a run of equal letters counts at its first only
    one = F.struct("n", (-F.col("id")).alias("minus_id"))
    pairs = pairs.withColumn("one", one)
    group = Window.partitionBy("p", "s").orderBy(F.desc("skip"), F.desc("n"), "id")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = pairs.select(
        "id", "skip", "first", F.row_number().over(group).alias("at"),
        F.count_if("skip").over(whole).alias("skips"), F.count_if("first").over(whole).alias("firsts"),
        F.first(F.when(F.col("skip"), F.col("one")), ignorenulls=True).over(whole).alias("top"),
        F.nth_value(F.when(F.col("skip"), F.col("one")), 2).over(whole).alias("second"),
        F.first(F.when(F.col("first"), F.col("one")), ignorenulls=True).over(whole).alias("top_first"),
        F.first(F.when(~F.col("skip"), F.col("one")), ignorenulls=True).over(whole).alias("cut"))
    longer = F.when(F.col("first"), F.col("cut"))
    found = met.select(
        "id",
        F.when(F.col("skip"), F.col("skips") - 1 + F.when(longer.isNotNull(), 1).otherwise(0))
        .otherwise(F.col("firsts")).alias("n_near"),
        F.when(F.col("skip"), F.greatest(F.when(F.col("at") == 1, F.col("second")).otherwise(F.col("top")), longer))
        .otherwise(F.col("top_first")).alias("best"))
    near = (found.where("n_near > 0").groupBy("id")
            .agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best")))
    return both.select("id", "word", "n"), near


def group_variants(words: DataFrame, much: int = MUCH) -> DataFrame:
    """Of distinct ``words`` (word, n): word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: first in code-point order)
    if that is at least ``much`` times the word's own n, else null; ``root``
    is where following forms ends.  Every step multiplies n by ``much`` or
    more, so paths end; they are halved round by round.  An empty table gives
    no rows.
    """
    spark = words.sparkSession
    scratch = Scratch(spark, "spelling")
    all_words, near = neighbours(scratch.table(words.select("word", "n"), "words"), scratch)
    is_form = F.col("best.n") >= much * F.col("n")
    rows = scratch.table(
        all_words.join(near, "id", "left")
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(is_form, -F.col("best.minus_id")).alias("form_id"),
                F.when(is_form, F.col("best.n")).alias("form_n")), "forms")
    up = rows.where(F.col("form_id").isNotNull()).select("id", F.col("form_id").alias("root_id"))
    step = 0
    while True:
        further = up.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
        joined = up.join(further, "root_id", "left")
        now = scratch.table(joined.select("id", F.coalesce("next", "root_id").alias("root_id"),
                                          F.col("next").isNotNull().alias("moved")), f"roots-{step}")
        moved = now.where("moved").limit(1).count()
        up, step = now.select("id", "root_id"), step + 1
        if not moved:
            break
    names = rows.select("id", "word")
    return (rows.join(up, "id", "left")
            .join(names.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id", "left")
            .join(names.select(F.col("id").alias("root_id"), F.col("word").alias("root")), "root_id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op13_spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of all documents with their standard form: word, form, root, n, n_near, form_n.

    Null texts have no words; a null id counts as the empty string where
    letters are taken out; repeated rows count again.
    """
    small_batches(docs.sparkSession)
    return group_variants(vocabulary(spoilt_words(docs)))
