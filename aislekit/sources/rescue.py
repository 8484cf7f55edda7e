"""Reading CSV tables by the catalog, keeping what breaks the schema.

Nothing is inferred and no row is dropped: every declared column is read as
text and parsed to its type; a value that doesn't parse is null in its column
and kept as text in ``_rescued``, under the column's name.  Columns that the
catalog doesn't know, and lines with too few or too many fields, are kept
there as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislekit.operators.contract_runner import TEXT_FORM, _whole, sample_of
from aislekit.sources import catalog
from aislekit.sources.decode import normalise_bool, parse_list

RESCUED, LINE = "_rescued", "_line"


def parse_column(c: catalog.Column, text: Column) -> Column:
    """The typed value of a text, null where it isn't one."""
    ok = lambda x: F.when(_whole(text, TEXT_FORM[c.type]), x)
    if c.type == "int":
        return ok(F.regexp_replace(text, r"\.0*$", "").try_cast("bigint"))
    if c.type == "float":
        return ok(text.try_cast("double"))
    if c.type == "bool":
        return ok(normalise_bool(text))
    if c.type == "date":
        return F.try_to_timestamp(text).cast("date")
    if c.type == "datetime":
        return F.try_to_timestamp(text).cast("timestamp_ntz")
    if c.type == "list[string]":
        return ok(parse_list(text))
    if c.type == "list[dict]":
        return ok(F.from_json(F.translate(text, "'", '"'), "array<map<string,string>>"))
    return text


def typed(raw: DataFrame, table: catalog.Table) -> DataFrame:
    """Text columns as the declared types, with ``_rescued`` (column -> text); missing columns are null."""
    there = [c for c in raw.columns if c != LINE]
    known = {c.name for c in table.columns}
    cols, kept = [], []
    for c in table.columns:
        if c.name in there:
            value = parse_column(c, F.col(c.name))
            kept.append((c.name, F.when(value.isNull(), F.col(c.name))))
        else:
            value = F.lit(None)
        cols.append(value.cast(catalog.SPARK_TYPES[c.type]).alias(c.name))
    kept += [(c, F.col(c)) for c in there if c not in known]
    if LINE in raw.columns:
        kept.append((LINE, F.col(LINE)))
    rescued = F.map_filter(F.map_from_arrays(F.array(*[F.lit(n) for n, _ in kept]), F.array(*[v.cast("string") for _, v in kept])),
                           lambda k, v: v.isNotNull())
    return raw.select(*cols, rescued.alias(RESCUED))


def read_rescued(spark: SparkSession, path: str, table: catalog.Table, escape: str = '"') -> DataFrame:
    """A table from CSV with a header, in its declared types, with ``_rescued``."""
    header = spark.read.option("header", True).option("escape", escape).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, LINE]])
    raw = (spark.read.schema(schema).option("header", True).option("escape", escape).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", LINE).csv(path))
    return typed(raw, table)


def rescue_report(df: DataFrame, table: catalog.Table) -> DataFrame:
    """What a read rescued: table_name, column_name, rescued, sample (texts, one a slot)."""
    e = df.select(F.explode(RESCUED).alias("column_name", "value"))
    found = e.groupBy("column_name").agg(F.count(F.lit(1)).alias("rescued"), F.array(*sample_of(F.lit(True), F.col("value"))).alias("__s"))
    return found.select(F.lit(table.name).alias("table_name"), "column_name", "rescued", F.array_sort(F.array_compact("__s")).alias("sample"))
