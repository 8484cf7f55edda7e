"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``;
``run`` writes a stage's rows as Parquet in the shared folder and gives them
to the next one.  The first three return the columns they got, the last one
the packed pieces.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislekit.llm import decontamination, near_dup, packing, toxicity
from aislekit.llm._common import Scratch, table

#: A document goes from this toxicity score on.
TOXIC = 0.5
#: A document goes if it holds this share of a benchmark item's 5-word shingles.
CONTAINED = 0.75


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold.

    The model is learnt from labelled rows of the table as it came in.  Null
    and empty texts score like any other text.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, name="__toxicity").where(F.col("__toxicity") < TOXIC).drop("__toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, that of the smallest id; texts without words stay."""
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows go by their id and text: one without id takes no other with it, nor
    does one that shares its id with another text.  Null texts stay.
    """
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64(F.coalesce("text", F.lit(""))).cast("string"))
    keyed = docs.withColumn("__document", key)
    found = decontamination.contaminated(keyed, table(spark, sf_dir, "benchmark"), CONTAINED, id_col="__document")
    keys = Scratch(spark, "pipeline").table(found.select(F.col("__document").alias("__bad")).distinct(), "contaminated")
    if keys.count() <= decontamination.BROADCAST_IDS:
        keys = F.broadcast(keys)
    return keyed.join(keys, F.col("__document") == F.col("__bad"), "left_anti").drop("__document")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens; null texts are empty."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("packing", pack)]

#: Compression lengths, sketches and tokens are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline-run")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
