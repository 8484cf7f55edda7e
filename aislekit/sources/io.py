"""Table readers and writers at the edge.

Reads always carry a declared schema (no inference); array columns travel
through CSV as JSON text.  Row counts come from an ``Observation`` on the
write itself, not from a second scan.  Output folders are placed under
the shared folder the cluster names (``spark.checkpoint.dir``) unless a
path is given.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislekit.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "aislekit", *parts, uuid.uuid4().hex)


def encode_for_csv(df: DataFrame) -> DataFrame:
    """Arrays / structs / maps become JSON text (CSV has no nesting)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> int:
    """Write with a header (CSV) and return the row count observed
    during the write."""
    obs = Observation("write_table")
    out = encode_for_csv(df) if fmt == "csv" else df
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return int(obs.get["rows"])


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
               decoders: dict | None = None) -> DataFrame:
    """Read with the declared schema; array columns arrive as text and
    are decoded by ``decoders`` {column: Column -> Column}."""
    if fmt == "csv":
        text_schema = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.ArrayType, T.StructType))
                                                  else f.dataType, True) for f in schema.fields])
        df = spark.read.schema(text_schema).option("header", True).csv(path)
    else:
        df = spark.read.schema(schema).format(fmt).load(path)
    for c, dec in (decoders or {}).items():
        df = df.withColumn(c, dec(F.col(c)))
    return df


def write_summary(summary: DataFrame, path: str) -> int:
    """The per-table profile summary, ordered by dirty ratio, as one
    CSV (it is one row per table)."""
    return write_table(summary.orderBy(F.desc("dirty_ratio"), "dataset").coalesce(1), path)
