"""Schema contracts (V01-V16): declared rules checked as Spark aggregates.

Row rules of one table (types of raw text, date parsing, accepted values,
regex, ranges, nulls) are evaluated together in a single ``agg`` so the
table is scanned once.  Set rules (keys unique, foreign keys, list
elements) are grouped counts or anti joins; grouped counts are partially
aggregated, so a hot key does not pile up in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPARK_TYPE = {
    "string": T.StringType, "int": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "float": (T.DoubleType, T.FloatType, T.DecimalType, T.IntegerType, T.LongType),
    "bool": T.BooleanType, "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}
_CAST = {"int": "bigint", "float": "double", "bool": "boolean", "string": "string"}


def _empty(df: DataFrame, ddl: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], ddl)


def type_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per declared column -> (column_name, declared, checked, failed).

    A typed column passes when its Spark type fits the declaration; a text
    column is checked value by value (``try_cast``), so a CSV read as
    strings is validated too.  A whole float counts as an int.
    """
    aggs, meta = [], []
    fields = {f.name: f.dataType for f in df.schema.fields}
    for i, (c, want) in enumerate(types.items()):
        if c not in fields:
            continue
        dt = fields[c]
        col = F.col(c)
        if want.startswith("list"):
            ok = isinstance(dt, T.ArrayType)
            bad = F.lit(False) if ok else col.isNotNull()
        elif isinstance(dt, T.StringType) and want != "string":
            parsed = col.try_cast(_CAST[want]) if want != "int" else col.try_cast("double")
            bad = col.isNotNull() & parsed.isNull()
            if want == "int":
                bad = bad | (parsed.isNotNull() & (parsed != F.floor(parsed)))
        else:
            ok = isinstance(dt, _SPARK_TYPE[want])
            bad = F.lit(False) if ok else col.isNotNull()
        aggs += [F.count(col).alias(f"n{i}"), F.count_if(bad).alias(f"b{i}")]
        meta.append((i, c, want))
    if not meta:
        return _empty(df, "column_name string, declared string, checked long, failed long")
    wide = df.agg(*aggs)
    args = ", ".join(f"'{c}', '{w}', n{i}, b{i}" for i, c, w in meta)
    return wide.selectExpr(f"stack({len(meta)}, {args}) AS (column_name, declared, checked, failed)")


def parse_failures(df: DataFrame, columns: list[str], kind: str = "date") -> DataFrame:
    """Values that do not parse as a date (timestamp).
    -> (column_name, checked, failed)."""
    aggs, cols = [], []
    for i, c in enumerate(columns):
        if c not in df.columns:
            continue
        col = F.col(c).cast("string")
        parsed = F.try_to_timestamp(col) if kind != "date" else F.coalesce(
            F.try_to_timestamp(col, F.lit("yyyy-MM-dd")), F.try_to_timestamp(col))
        aggs += [F.count(col).alias(f"n{i}"), F.count_if(col.isNotNull() & parsed.isNull()).alias(f"b{i}")]
        cols.append((i, c))
    if not cols:
        return _empty(df, "column_name string, checked long, failed long")
    args = ", ".join(f"'{c}', n{i}, b{i}" for i, c in cols)
    return df.agg(*aggs).selectExpr(f"stack({len(cols)}, {args}) AS (column_name, checked, failed)")


def duplicate_keys(df: DataFrame, keys: list[str], ignore_nulls: bool = False) -> DataFrame:
    """Key values held by more than one row -> keys + n."""
    d = df
    if ignore_nulls:
        d = d.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return (d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def list_bridge_duplicates(df: DataFrame, parent: str, list_col: str, bridge: str) -> DataFrame:
    """(parent, list element) pairs seen more than once; double quotes
    are stripped and the element trimmed first."""
    e = df.select(F.col(parent), F.explode(list_col).alias("__v"))
    e = e.select(parent, F.trim(F.replace(F.col("__v").cast("string"), F.lit('"'), F.lit(""))).alias(bridge))
    return duplicate_keys(e, [parent, bridge])


def orphan_keys(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows whose non-null ``col`` is absent from the parent key."""
    p = parent.select(F.col(parent_col).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    return df.where(F.col(col).isNotNull()).join(p, F.col(col) == F.col("__k"), "left_anti")


def orphan_list_elements(df: DataFrame, key: str, list_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """List elements (quotes stripped, blanks ignored) absent from the
    parent key, compared as text -> (key, element)."""
    e = df.select(F.col(key), F.explode_outer(list_col).alias("__v"))
    e = e.select(key, F.trim(F.replace(F.col("__v").cast("string"), F.lit('"'), F.lit(""))).alias("element"))
    e = e.where(F.col("element").isNotNull() & (F.col("element") != ""))
    p = parent.select(F.col(parent_col).cast("string").alias("__k")).where(F.col("__k").isNotNull()).distinct()
    return e.join(p, F.col("element") == F.col("__k"), "left_anti")


def value_not_accepted(col: Column, allowed: list) -> Column:
    """V11 predicate: a non-null value outside the accepted list."""
    return col.isNotNull() & ~col.isin(allowed)


def regex_mismatch(col: Column, pattern: str) -> Column:
    """V12 predicate: non-null, non-empty text that does not fully match."""
    s = col.cast("string")
    return s.isNotNull() & (s != "") & ~s.rlike("^(?:" + pattern + r")\z")


def out_of_range(col: Column, lo=None, hi=None) -> Column:
    """V15 predicate: value below ``lo`` or above ``hi`` (open ends)."""
    conds = []
    if lo is not None:
        conds.append(col < lo)
    if hi is not None:
        conds.append(col > hi)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def nested_orphans(df: DataFrame, key: str, list_col: str, id_key: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Ids inside a list of structs absent from the parent -> (key, id)."""
    e = (df.select(F.col(key), F.explode(list_col).alias("__s"))
         .select(key, F.col(f"__s.{id_key}").cast("string").alias(id_key))
         .where(F.col(id_key).isNotNull()))
    p = parent.select(F.col(parent_col).cast("string").alias("__k")).distinct()
    return e.join(p, F.col(id_key) == F.col("__k"), "left_anti")


def nested_bridge_duplicates(df: DataFrame, parent: str, list_col: str, id_key: str) -> DataFrame:
    """(parent, nested id) pairs seen more than once."""
    e = (df.select(F.col(parent), F.explode(list_col).alias("__s"))
         .select(parent, F.col(f"__s.{id_key}").cast("string").alias(id_key))
         .where(F.col(id_key).isNotNull()))
    return duplicate_keys(e, [parent, id_key])


def row_rule_counts(df: DataFrame, contract: dict) -> DataFrame:
    """Row rules of one contract in ONE aggregate -> (rule, column_name, checked, failed)."""
    preds: list[tuple[str, str, Column, Column]] = []
    cols = set(df.columns)
    for c in contract.get("required", []):
        if c in cols:
            preds.append(("not_null", c, F.lit(True), F.col(c).isNull()))
    for c, allowed in contract.get("accepted_values", {}).items():
        if c in cols:
            preds.append(("accepted_values", c, F.col(c).isNotNull(), value_not_accepted(F.col(c), allowed)))
    for c, pat in contract.get("regex", {}).items():
        if c in cols:
            preds.append(("regex", c, F.col(c).isNotNull() & (F.col(c).cast("string") != ""), regex_mismatch(F.col(c), pat)))
    for c, (lo, hi) in contract.get("ranges", {}).items():
        if c in cols:
            preds.append(("range", c, F.col(c).isNotNull(), out_of_range(F.col(c), lo, hi)))
    if not preds:
        return _empty(df, "rule string, column_name string, checked long, failed long")
    aggs = []
    for i, (_, _, chk, bad) in enumerate(preds):
        aggs += [F.count_if(chk).alias(f"n{i}"), F.count_if(F.coalesce(bad, F.lit(False))).alias(f"b{i}")]
    args = ", ".join(f"'{r}', '{c}', n{i}, b{i}" for i, (r, c, _, _) in enumerate(preds))
    return df.agg(*aggs).selectExpr(f"stack({len(preds)}, {args}) AS (rule, column_name, checked, failed)")


def run_contract(table: str, df: DataFrame, contract: dict, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every rule of one table -> (table_name, rule, column_name, checked, failed).

    Row rules share one scan; each key / reference rule adds one grouped
    count or anti join.  Only counts leave the executors.  ``parents`` must
    hold the parent table of every foreign key.  Rules of columns that ``df``
    does not have are passed over, and so are date and timestamp columns
    (``parse_failures``).
    """
    parents = parents or {}
    parts = [row_rule_counts(df, contract)]
    tf = type_failures(df, contract.get("types", {}))
    parts.append(tf.select(F.lit("type").alias("rule"), "column_name", "checked", "failed"))
    total = df.agg(F.count(F.lit(1)).alias("checked"))

    def set_rule(rule: str, column: str, failed: DataFrame) -> DataFrame:
        return total.crossJoin(failed).select(  # 1 x 1 rows
            F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), "checked", "failed")

    def rows_in_dups(dup: DataFrame) -> DataFrame:  # every row of a repeated key fails
        return dup.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed"))

    if contract.get("pk"):
        parts.append(set_rule("pk_unique", ",".join(contract["pk"]), rows_in_dups(duplicate_keys(df, contract["pk"]))))
    for combo in contract.get("unique_combinations", []):
        parts.append(set_rule("unique_combination", ",".join(combo), rows_in_dups(duplicate_keys(df, combo))))
    for c in contract.get("unique_columns", []):
        parts.append(set_rule("unique_column", c, rows_in_dups(duplicate_keys(df, [c], ignore_nulls=True))))
    for c, (ref, ref_col) in contract.get("fk", {}).items():
        if c in df.columns:
            if ref not in parents:
                raise ValueError(f"{table}.{c}: the parent table {ref} is not given")
            parts.append(set_rule("fk", c, orphan_keys(df, c, parents[ref], ref_col).agg(F.count(F.lit(1)).alias("failed"))))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(table).alias("table_name"), "rule", "column_name",
                      F.col("checked").cast("long").alias("checked"), F.col("failed").cast("long").alias("failed"))
