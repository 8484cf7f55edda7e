"""Data-quality profiling over a table carrying ``error_types`` (Q01-Q13).

All statistics are aggregates that Spark computes with partial (map-side)
aggregation: a table of any size is reduced per partition before the
shuffle, and the shuffle carries one small row per group; quantiles are
selected from value counts in ranges.  Nothing is collected; the only driver-side work is reading the schema to pick the
numeric columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislekit.operators.sequence import running_total_in_ranges

ERR = "error_types"

# Severity keywords, checked in this order; first match wins.
SEVERITY_KEYWORDS = [
    ("duplicate", "medium"),
    ("future", "high"),
    ("negative", "high"),
    ("missing", "medium"),
    ("formatting", "low"),
    ("whitespace", "low"),
    ("mismatch", "medium"),
    ("outlier", "high"),
    ("invalid", "high"),
    ("orphan", "high"),
    ("duplicate row", "medium"),
]

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def with_error_types(df: DataFrame) -> DataFrame:
    """An absent ``error_types`` column becomes an empty list per row."""
    if ERR in df.columns:
        return df.withColumn(ERR, F.coalesce(F.col(ERR), F.array().cast("array<string>")))
    return df.withColumn(ERR, F.array().cast("array<string>"))


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = (), id_suffix: str = "_id") -> list[str]:
    """Numeric measure columns.  Identifier columns (``*_id``) are strings in
    the source data model, so they are left out here too."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in exclude
            and not (id_suffix and f.name.endswith(id_suffix)) and f.name != "num_errors"]


def error_counts(df: DataFrame) -> DataFrame:
    """Q01: occurrences of each error label -> (error_type, error_count)."""
    return (with_error_types(df)
            .select(F.explode(ERR).alias("error_type"))
            .groupBy("error_type").agg(F.count(F.lit(1)).alias("error_count")))


def dirty_row_stats(df: DataFrame) -> DataFrame:
    """Q02: one row (total_rows, dirty_rows, clean_rows, dirty_ratio)."""
    d = with_error_types(df)
    return (d.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(F.size(ERR) > 0).alias("dirty_rows"))
            .select("total_rows", "dirty_rows",
                    (F.col("total_rows") - F.col("dirty_rows")).alias("clean_rows"),
                    F.coalesce(F.try_divide(F.col("dirty_rows").cast("double"), F.col("total_rows")),
                               F.lit(0.0)).alias("dirty_ratio")))


def error_density(df: DataFrame) -> DataFrame:
    """Q03: rows by number of errors -> (num_errors, row_count), ordered."""
    return (with_error_types(df)
            .groupBy(F.size(ERR).cast("long").alias("num_errors"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy("num_errors"))


def top_corrupted_columns(df: DataFrame) -> DataFrame:
    """Q04: last whitespace token of each label, summed -> (column_name, error_count)."""
    counts = error_counts(df).filter(F.size(F.split(F.trim("error_type"), r"\s+")) > 0)
    tok = F.element_at(F.split(F.trim("error_type"), r"\s+"), -1)
    return (counts.filter(F.trim("error_type") != "")
            .groupBy(tok.alias("column_name"))
            .agg(F.sum("error_count").cast("long").alias("error_count")))


def _stack(cols: list[str], exprs: dict[str, str], df_agg: DataFrame) -> DataFrame:
    """Turn one wide aggregate row into one row per column (SQL ``stack``)."""
    names = list(exprs)
    args = ", ".join(
        f"'{c}', " + ", ".join(f"`{c}__{n}`" for n in names) for c in cols)
    return df_agg.selectExpr(f"stack({len(cols)}, {args}) AS (column_name, {', '.join(names)})")


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Linear quantiles by distributed selection -> (column_name, n, prob, value).

    Rows are reduced to counts per (column, value) first; the counts run on in
    ranges of values, and the values at the two ranks a quantile lies between
    are picked by a join with the few wanted ranks.  No task holds more than a
    range of the distinct values.  Columns without a value have no rows.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])))
    counts = long.where(F.col("x").isNotNull()).groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("n"))
    upto = running_total_in_ranges(counts, ["column_name", "x"], "n", "__to", ["column_name"])
    sizes = upto.groupBy("column_name").agg(F.sum("n").alias("__n"))
    place = (F.col("__n") - 1) * F.col("prob")
    wanted = sizes.select("column_name", "__n", F.explode(F.array(*[F.lit(p) for p in probs])).alias("prob")).select(
        "column_name", "__n", "prob", place.alias("__at"))
    ends = F.broadcast(wanted.select("*", F.floor("__at").alias("__lo"), F.ceil("__at").alias("__hi")))  # columns x probs rows
    met = upto.join(ends, "column_name")
    holds = lambda k: (F.col(k) >= F.col("__to") - F.col("n")) & (F.col(k) < F.col("__to"))
    met = met.where(holds("__lo") | holds("__hi"))
    found = met.groupBy("column_name", "prob").agg(
        F.max("__n").alias("n"), F.max("__at").alias("__at"), F.max("__lo").alias("__lo"), F.max("__hi").alias("__hi"),
        F.max(F.when(holds("__lo"), F.col("x"))).alias("a"), F.max(F.when(holds("__hi"), F.col("x"))).alias("b"))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
        (F.col("__hi") - F.col("__at")) * F.col("a") + (F.col("__at") - F.col("__lo")) * F.col("b"))
    return found.select("column_name", "n", "prob", value.alias("value"))


def numeric_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Q05: mean, median, sample std, min, max (round 2) per numeric column.

    One aggregate over all columns (one scan), then ``stack`` to rows; the
    medians come from ``exact_quantiles``.  Columns with no non-null value are
    skipped.
    """
    cols = columns if columns is not None else numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, mean double, median double, std double, min double, max double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    long = _stack(cols, {s: s for s in ["n", "mean", "std", "min", "max"]}, wide)
    medians = exact_quantiles(df, cols, [0.5]).select("column_name", F.col("value").alias("median"))
    return (long.filter(F.col("n") > 0).join(F.broadcast(medians), "column_name")  # a row a column
            .select("column_name", *[F.round(F.col(s), 2).alias(s) for s in ["mean", "median", "std", "min", "max"]]))


def outliers(df: DataFrame, columns: list[str] | None = None, min_values: int = 10) -> DataFrame:
    """Q06: IQR rule (1.5 x IQR around linear Q1/Q3) per numeric column.

    The quartiles come from ``exact_quantiles``; a single counting pass against
    the broadcast one-row bounds follows.
    """
    cols = columns if columns is not None else numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, outlier_count long, outlier_ratio double")
    at = lambda c, p: F.max(F.when((F.col("column_name") == c) & (F.col("prob") == p), F.col("value")))
    bounds = exact_quantiles(df, cols, [0.25, 0.75]).agg(*[a for c in cols for a in (
        at(c, 0.25).alias(f"{c}__q1"), at(c, 0.75).alias(f"{c}__q3"),
        F.coalesce(F.max(F.when(F.col("column_name") == c, F.col("n"))), F.lit(0)).alias(f"{c}__n"))])
    lo_hi = []
    for c in cols:
        q1, q3 = F.col(f"{c}__q1"), F.col(f"{c}__q3")
        iqr = q3 - q1
        lo_hi += [(q1 - 1.5 * iqr).alias(f"{c}__lo"), (q3 + 1.5 * iqr).alias(f"{c}__hi"),
                  F.col(f"{c}__n")]
    bounds = bounds.select(*lo_hi)
    counted = df.crossJoin(F.broadcast(bounds))  # bounds is exactly one row
    cnt = []
    for c in cols:
        x = F.col(c).cast("double")
        cnt += [F.count_if((x < F.col(f"{c}__lo")) | (x > F.col(f"{c}__hi"))).alias(f"{c}__out"),
                F.first(f"{c}__n").alias(f"{c}__n")]
    wide = counted.agg(*cnt)
    long = _stack(cols, {"out": "out", "n": "n"}, wide)
    return (long.filter(F.col("n") >= min_values)
            .select("column_name", F.col("out").cast("long").alias("outlier_count"),
                    F.round(F.col("out") / F.col("n"), 4).alias("outlier_ratio")))


def severity_of(label: Column) -> Column:
    """Q07 scalar: first keyword (fixed order) contained in the lower label."""
    low = F.lower(label)
    expr = None
    for kw, sev in SEVERITY_KEYWORDS:
        cond = low.contains(kw)
        expr = F.when(cond, sev) if expr is None else expr.when(cond, sev)
    return expr.otherwise("unknown")


def severity_breakdown(df: DataFrame) -> DataFrame:
    """Q07: error counts summed by severity -> (severity, error_count)."""
    return (error_counts(df).groupBy(severity_of(F.col("error_type")).alias("severity"))
            .agg(F.sum("error_count").cast("long").alias("error_count")))


def health_score(dirty_ratio: Column) -> Column:
    """Q08: round(max(0, 100 - 100 * ratio), 2)."""
    return F.round(F.greatest(F.lit(0.0), 100 - dirty_ratio * 100), 2)


def validation_checks(df: DataFrame) -> DataFrame:
    """Q09-Q11 in one scan: transaction math, inverted dates, negative prices.

    Which checks apply depends on the columns present (as in the source);
    a missing discount / fee column counts as 0.  -> (check_name, violations)
    """
    cols = set(df.columns)
    checks: list[tuple[str, Column]] = []
    if {"transaction_total", "cart_subtotal", "shipping_fee"} <= cols:
        def z(c):
            return F.coalesce(F.col(c), F.lit(0)) if c in cols else F.lit(0)
        expected = F.col("cart_subtotal") - z("total_discount") + z("shipping_fee") - z("shipping_discount")
        checks.append(("transaction_math_mismatch", F.abs(F.col("transaction_total") - expected) > 0.01))
    if {"effective_start_date", "effective_end_date"} <= cols:
        checks.append(("inverted_date_ranges",
                       F.col("effective_end_date").cast("timestamp") < F.col("effective_start_date").cast("timestamp")))
    for f in df.schema.fields:
        if "price" in f.name.lower() and isinstance(f.dataType, _NUMERIC):
            checks.append((f"negative_{f.name}", F.col(f.name) < 0))
    if not checks:
        return df.sparkSession.createDataFrame([], "check_name string, violations long")
    wide = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in checks])
    args = ", ".join(f"'{n}', `{n}`" for n, _ in checks)
    return wide.selectExpr(f"stack({len(checks)}, {args}) AS (check_name, violations)")


def profile_dataset(df: DataFrame, dataset: str, columns: list[str] | None = None) -> DataFrame:
    """Q12: one summary row for a table.

    (dataset, total_rows, dirty_rows, dirty_ratio, health_score,
    total_error_types, total_errors, top_error, numeric_columns).
    Ties for the top error go to the smallest label.
    """
    d = with_error_types(df)
    cols = columns if columns is not None else numeric_columns(d)
    stats = d.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(F.size(ERR) > 0).alias("dirty_rows"),
                  *[F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(cols)])
    nn = [F.when(F.col(f"__nn_{i}") > 0, 1).otherwise(0) for i in range(len(cols))]
    numeric_n = reduce(lambda a, b: a + b, nn) if nn else F.lit(0)
    errs = (error_counts(d)
            .agg(F.count(F.lit(1)).alias("total_error_types"),
                 F.sum("error_count").alias("total_errors"),
                 F.min(F.struct((-F.col("error_count")).alias("neg"),
                                F.col("error_type").alias("error_type"))).alias("_top")))
    ratio = F.coalesce(F.try_divide(F.col("dirty_rows").cast("double"), F.col("total_rows")), F.lit(0.0))
    return (stats.crossJoin(errs)  # both sides are single-row aggregates
            .select(F.lit(dataset).alias("dataset"),
                    F.col("total_rows"), F.col("dirty_rows"),
                    F.round(ratio, 4).alias("dirty_ratio"),
                    health_score(ratio).alias("health_score"),
                    F.col("total_error_types"),
                    F.coalesce(F.col("total_errors"), F.lit(0)).cast("long").alias("total_errors"),
                    F.col("_top.error_type").alias("top_error"),
                    numeric_n.cast("long").alias("numeric_columns")))


PROFILE_DDL = ("dataset string, status string, detail string, total_rows long, dirty_rows long, dirty_ratio double, health_score double, "
               "total_error_types long, total_errors long, top_error string, numeric_columns long")


def profile_sources(spark: SparkSession, sources: dict, columns: dict[str, list[str]] | None = None) -> DataFrame:
    """Profiles of several tables, by dirty ratio; a missing table is skipped and a failing one reported.

    ``sources`` maps names to functions that give a DataFrame.  A table whose
    path doesn't exist has the status 'missing', one that can't be read or
    profiled 'failed' with the error's first line; neither ends the run.  One
    row a table reaches the driver.
    """
    rows = []
    for name, source in sources.items():
        try:
            r = profile_dataset(source(), name, (columns or {}).get(name)).first().asDict()
            rows.append({"status": "profiled", "detail": None, **r})
        except Exception as e:  # noqa: BLE001 - whatever is wrong with one table, the others are profiled
            missing = isinstance(e, AnalysisException) and e.getCondition() == "PATH_NOT_FOUND"
            rows.append({"dataset": name, "status": "missing" if missing else "failed", "detail": str(e).strip().split("\n")[0]})
    names = [c.split()[0] for c in PROFILE_DDL.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PROFILE_DDL).orderBy(
        F.desc_nulls_last("dirty_ratio"), "dataset")


def text_report(df: DataFrame, dataset: str, columns: list[str] | None = None, top: int = 15) -> DataFrame:
    """A table's report as ordered lines (section, line, text), each made from an aggregate."""
    d = with_error_types(df)
    cols = columns if columns is not None else numeric_columns(d)

    def lines(n: int, part: DataFrame, order: list, text: Column) -> DataFrame:
        at = Window.orderBy(*order)  # a few lines: labels, columns or severities
        return part.select(F.lit(n).alias("section"), F.row_number().over(at).alias("line"), text.alias("text"))

    stats = dirty_row_stats(d).withColumn("health", health_score(F.col("dirty_ratio")))
    parts = [lines(1, stats, ["total_rows"], F.format_string(f"{dataset}: %d rows, %d dirty, %d clean, health %.2f", "total_rows", "dirty_rows", "clean_rows", "health")),
             lines(2, error_counts(d).orderBy(F.desc("error_count"), "error_type").limit(top), [F.desc("error_count"), "error_type"],
                   F.format_string("%s: %d", "error_type", "error_count")),
             lines(3, error_density(d), ["num_errors"], F.format_string("%d errors: %d rows", "num_errors", "row_count")),
             lines(4, severity_breakdown(d), [F.desc("error_count"), "severity"], F.format_string("%s: %d", "severity", "error_count"))]
    if cols:
        parts += [lines(5, numeric_profile(d, cols), ["column_name"],
                        F.format_string("%s: mean %.2f, median %.2f, std %.2f, min %.2f, max %.2f", "column_name", "mean", "median", "std", "min", "max")),
                  lines(6, outliers(d, cols), ["column_name"], F.format_string("%s: %d outliers", "column_name", "outlier_count"))]
    return reduce(DataFrame.union, parts).orderBy("section", "line")


def summary_report(profiles: list[DataFrame]) -> DataFrame:
    """The per-table profile rows, by dirty ratio descending."""
    return reduce(DataFrame.unionByName, profiles).orderBy(F.desc("dirty_ratio"), "dataset")
