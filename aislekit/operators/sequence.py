"""Per-key sequence primitives that stay parallel when one key is hot.

``lag`` / ``lead`` / running sums / carry-forward over ``partitionBy(key)``
put all rows of a key into one task.  Here each key is split into time
buckets (a month by default): the window runs per (key, bucket), in
parallel, and a tiny per-key window over *bucket summaries* (one row per
bucket) stitches the bucket edges.  The result equals the single-window
result for any data; a hot key costs as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_bucket(c: str) -> Column:
    return F.date_trunc("month", F.col(c).cast("timestamp_ntz"))


def _stitch(d: DataFrame, summary: DataFrame, on: list[str]) -> DataFrame:
    """Join bucket summaries back; rows without a key or a time have buckets too."""
    s = summary.select(*[F.col(k).alias(f"__s_{k}") for k in on], *[c for c in summary.columns if c not in on])
    cond = F.lit(True)
    for k in on:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__s_{k}"))
    return d.join(s, cond, "left").drop(*[f"__s_{k}" for k in on])


def may_be_hot(df: DataFrame, keys: list[str], most: int = 1_000_000, classes: int = 1 << 16) -> bool:
    """Whether a key may hold more than ``most`` rows; False is certain.

    Rows are counted by a bounded number of hash classes of the keys, so no
    more than that many numbers a task are shuffled.
    """
    of_class = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(classes)).alias("__class")).count()
    return (of_class.agg(F.max("count")).first()[0] or 0) > most


def neighbour(df: DataFrame, keys: list[str], order: list[str], cols: list[str], direction: str = "prev",
              prefix: str | None = None, bucket: Column | None = None, split: bool = True) -> DataFrame:
    """Add ``prev_<c>`` (lag 1) or ``next_<c>`` (lead 1) for each column.

    ``order`` must be a total order within a key (add a tie-break column).
    ``bucket`` must be monotone in the first order column (default: its
    month).  Without ``split`` (no hot key, see ``may_be_hot``) a key is one
    window: one shuffle on the keys, shared with other windows on them.
    """
    prefix = prefix or ("prev_" if direction == "prev" else "next_")
    if not split:
        w, fn = Window.partitionBy(*keys).orderBy(*order), F.lag if direction == "prev" else F.lead
        return df.select("*", *[fn(F.col(c)).over(w).alias(f"{prefix}{c}") for c in cols])
    b = bucket if bucket is not None else month_bucket(order[0])
    d = df.withColumn("__bk", b)
    w = Window.partitionBy(*keys, "__bk").orderBy(*order)
    fn = F.lag if direction == "prev" else F.lead
    d = d.select("*", fn(F.lit(1)).over(w).alias("__has"),
                 *[fn(F.col(c)).over(w).alias(f"{prefix}{c}") for c in cols])
    # bucket summaries: first and last row of each (key, bucket)
    edge = F.min if direction == "next" else F.max
    summ = d.groupBy(*keys, "__bk").agg(
        edge(F.struct(*[F.col(o) for o in order], *[F.col(c).alias(f"v_{c}") for c in cols])).alias("__e"))
    wb = Window.partitionBy(*keys).orderBy("__bk")
    other = F.lag("__e").over(wb) if direction == "prev" else F.lead("__e").over(wb)
    summ = summ.select(*keys, "__bk", other.alias("__o"))
    d = _stitch(d, summ, [*keys, "__bk"])
    out = [F.when(F.col("__has").isNull(), F.col(f"__o.v_{c}")).otherwise(F.col(f"{prefix}{c}")).alias(f"{prefix}{c}")
           for c in cols]
    keep = [c for c in df.columns]
    return d.select(*keep, *out)


def running_sum(df: DataFrame, keys: list[str], order: list[str], col: str, out: str,
                bucket: Column | None = None, split: bool = True) -> DataFrame:
    """Add ``out`` = sum of ``col`` (not null) over rows of the key up to this row; ``split`` as for ``neighbour``."""
    if not split:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(col).over(w))
    b = bucket if bucket is not None else month_bucket(order[0])
    d = df.withColumn("__bk", b)
    w = Window.partitionBy(*keys, "__bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__in", F.sum(col).over(w))
    tot = d.groupBy(*keys, "__bk").agg(F.sum(col).alias("__t"))
    wb = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, "__bk", F.coalesce(F.sum("__t").over(wb), F.lit(0)).alias("__before"))
    d = _stitch(d, tot, [*keys, "__bk"])
    return d.select(*df.columns, (F.col("__before") + F.col("__in")).alias(out))


def running_max(df: DataFrame, keys: list[str], order: list[str], col: str, out: str,
                bucket: Column | None = None) -> DataFrame:
    """Add ``out`` = greatest non-null ``col`` over rows of the key up to this row."""
    b = bucket if bucket is not None else month_bucket(order[0])
    d = df.withColumn("__bk", b)
    w = Window.partitionBy(*keys, "__bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__in", F.max(col).over(w))
    tops = d.groupBy(*keys, "__bk").agg(F.max(col).alias("__t"))
    wb = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*keys, "__bk", F.max("__t").over(wb).alias("__before"))
    d = _stitch(d, tops, [*keys, "__bk"])
    return d.select(*df.columns, F.greatest("__before", "__in").alias(out))


def range_parts(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` dealt into ranges of ``order``, with ``__part`` ascending along it.

    The ranges are cut by a sample of the rows, so a part holds about the same
    number of rows whatever the values are; the rows are written once to the
    shared folder, which freezes the parts.
    """
    from aislekit.sources.io import shared_path

    spark = df.sparkSession
    ranged = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn(
        "__part", F.spark_partition_id())
    path = shared_path(spark, "ranges")
    ranged.write.mode("overwrite").parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def running_total_in_ranges(df: DataFrame, order: list[str], weight: str, out: str, keys: list[str] | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` up to this row in ``order`` (inside ``keys``), with no window over a whole key.

    Rows are summed inside their range; the totals of the ranges before, one
    row each, shift them.  ``order`` begins with the keys.
    """
    keys = keys or []
    parts = range_parts(df, order)
    inside = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = parts.groupBy(*keys, "__part").agg(F.sum(weight).alias("__t"))
    # one row a range; without keys they stand in one task, as many as there are partitions
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(*keys, "__part", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__before"))
    return (parts.withColumn("__in", F.sum(weight).over(inside)).join(F.broadcast(shift), [*keys, "__part"])
            .select(*df.columns, (F.col("__before") + F.col("__in")).alias(out)))


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Add ``out`` = 1, 2, ... in ``order`` without gaps; ``order`` must tell rows apart."""
    one = df.withColumn("__w", F.lit(1))
    return running_total_in_ranges(one, order, "__w", out).drop("__w")


def carry_forward(df: DataFrame, keys: list[str], order: list[str], col: str, out: str,
                  bucket: Column | None = None) -> DataFrame:
    """Add ``out`` = last non-null ``col`` at or before this row of the key."""
    b = bucket if bucket is not None else month_bucket(order[0])
    d = df.withColumn("__bk", b)
    w = Window.partitionBy(*keys, "__bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__in", F.last(col, ignorenulls=True).over(w))
    lastb = d.groupBy(*keys, "__bk").agg(
        F.max(F.when(F.col(col).isNotNull(), F.struct(*[F.col(o) for o in order], F.col(col).alias("v")))).alias("__l"))
    wb = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    lastb = lastb.select(*keys, "__bk", F.last(F.col("__l.v"), ignorenulls=True).over(wb).alias("__before"))
    d = _stitch(d, lastb, [*keys, "__bk"])
    return d.select(*df.columns, F.coalesce(F.col("__in"), F.col("__before")).alias(out))


def asof_lookup(probes: DataFrame, facts: DataFrame, keys: list[str], probe_ts: str, fact_ts: str,
                value: str, out: str, default=None, tie: str | None = None) -> DataFrame:
    """As-of join: for each probe, ``value`` of the latest fact of the same
    key with ``fact_ts <= probe_ts`` (``default`` when none).

    Both sides are unioned (probe rows keep all their columns) and ordered
    by (ts, fact before probe, tie); the value is carried forward per key
    with ``carry_forward`` (bucketed by month), so the plan is one shuffle
    on the key, no row blow-up, and a hot key is split by month.  ``tie``
    orders facts that share a timestamp (the greatest wins).
    """
    pcols = [c for c in probes.columns if c not in keys]
    vt = facts.schema[value].dataType
    pk = probes.select(*keys, *pcols, F.col(probe_ts).cast("timestamp_ntz").alias("__ts"), F.lit(1).alias("__side"),
                       F.lit(None).cast(vt).alias("__v"), F.lit(None).cast("string").alias("__tie"))
    fk = facts.select(*keys, *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in pcols],
                      F.col(fact_ts).cast("timestamp_ntz").alias("__ts"), F.lit(0).alias("__side"),
                      F.col(value).alias("__v"),
                      (F.col(tie).cast("string") if tie else F.lit(None).cast("string")).alias("__tie"))
    u = pk.unionByName(fk)
    cf = carry_forward(u, keys, ["__ts", "__side", "__tie"], "__v", "__asof")
    v = F.coalesce(F.col("__asof"), F.lit(default)) if default is not None else F.col("__asof")
    return cf.where(F.col("__side") == 1).select(*probes.columns, v.alias(out))
