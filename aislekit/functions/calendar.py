"""Date and time classifiers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["time_of_day", "day_type", "pay_cycle", "seasonal_dimension", "overlaps_any", "campaign_progress_boost",
           "safe_window_end", "SEASONAL_DATES"]

# Seasonal events by type and calendar date.
SEASONAL_DATES = {
    "Commercial Mega Sale": {
        "Black Friday": ["2023-11-24", "2024-11-29", "2025-11-28"],
        "1111": ["2023-11-11", "2024-11-11", "2025-11-11"],
        "1212": ["2023-12-12", "2024-12-12", "2025-12-12"],
    },
    "Cultural Festival": {
        "Chinese New Year": ["2023-01-22", "2024-02-10", "2025-01-29"],
        "Hari Raya Puasa": ["2023-04-21", "2024-04-09", "2025-03-30"],
        "Diwali": ["2023-11-10", "2024-10-29", "2025-10-18"],
        "Christmas": ["2023-12-25", "2024-12-25", "2025-12-25"],
    },
}


def time_of_day(ts: Column) -> Column:
    """hour bands 0-5, 5-8, 8-12, 12-17, 17-21, 21-24."""
    h = F.hour(ts)
    return (F.when(h < 5, "Late Night").when(h < 8, "Early Morning").when(h < 12, "Morning")
            .when(h < 17, "Afternoon").when(h < 21, "Evening").when(h.isNotNull(), "Night"))


def day_type(ts: Column) -> Column:
    """Monday = 0; days 5 and 6 are the weekend."""
    return F.when(F.weekday(ts) >= 5, "Weekend").when(ts.isNotNull(), "Weekday")


def pay_cycle(ts: Column) -> Column:
    """day 1 or 15 -> Payday; 28-31 or 2 -> Payday Spillover; else null."""
    d = F.dayofmonth(ts)
    return F.when(d.isin(1, 15), "Payday").when(d.isin(28, 29, 30, 31, 2), "Payday Spillover")


def seasonal_dimension(spark: SparkSession) -> DataFrame:
    """F04 dimension: (event_date, season, season_type, rank).  21 fixed
    rows, so it is broadcast; rank keeps the first match of the source."""
    rows = []
    rank = 0
    for stype, seasons in SEASONAL_DATES.items():
        for season, dates in seasons.items():
            for d in dates:
                rows.append((_dt.date.fromisoformat(d), season, stype, rank))
                rank += 1
    return spark.createDataFrame(rows, "event_date date, season string, season_type string, season_rank int")


def overlaps_any(windows: Column, start: Column, end: Column,
                 start_field: str = "start", end_field: str = "end") -> Column:
    """any closed window w with start <= w.end and end >= w.start."""
    return F.exists(windows, lambda w: (start <= w[end_field]) & (end >= w[start_field]))


def safe_window_end(start: Column, end: Column, limit: Column) -> Column:
    """end = min(end, limit); if that falls before start, end = start."""
    return F.greatest(start, F.least(end, limit))


def campaign_progress_boost(progress: Column) -> Column:
    """F22 (one campaign): < 0.2 -> 1.3, < 0.8 -> 1.5, else 0.8."""
    return F.when(progress < 0.2, 1.3).when(progress < 0.8, 1.5).when(progress.isNotNull(), 0.8)
