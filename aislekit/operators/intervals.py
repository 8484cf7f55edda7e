"""Interval joins without a nested loop (own operators).

Spark plans a join whose only condition is a range as a nested loop.  Here
every interval is exploded into the calendar buckets (months by default)
it touches; both sides then meet on an equi key (the bucket), which Spark
can hash- or sort-merge-join and AQE can split when a bucket is skewed.
The exact range test is the residual.  Long intervals cost one row per
bucket they span, never a row per partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_buckets(start: Column, end: Column) -> Column:
    """First day of every month touched by [start, end] (array<date>)."""
    s = F.trunc(F.to_date(start), "month")
    e = F.trunc(F.to_date(F.greatest(start, end)), "month")
    return F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))


def point_in_interval_join(points: DataFrame, ts: str, intervals: DataFrame, start: str, end: str,
                           how: str = "inner", keys: list[str] | None = None) -> DataFrame:
    """Rows of ``points`` paired with every interval holding ``ts`` (closed ends).

    ``keys`` are extra equi-join columns present on both sides.  With
    ``how='left'`` points without an interval are kept with nulls.
    """
    keys = keys or []
    iv = intervals.select(*[F.col(c).alias(f"__ik_{c}") if c in keys else F.col(c) for c in intervals.columns],
                          F.explode(month_buckets(F.col(start), F.col(end))).alias("__ib"))
    pt = points.withColumn("__pb", F.trunc(F.to_date(F.col(ts)), "month"))
    cond = F.col("__pb") == F.col("__ib")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__ik_{k}"))
    cond = cond & (F.col(start) <= F.col(ts)) & (F.col(end) >= F.col(ts))
    j = pt.join(iv, cond, how)
    return j.drop("__pb", "__ib", *[f"__ik_{k}" for k in keys])
