"""Bands of scroll depth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["scroll_band"]


def scroll_band(scroll: Column) -> Column:
    """scroll depth bands <15, <30, <50, <75, rest."""
    return (F.when(scroll < 15, "0-15").when(scroll < 30, "15-30").when(scroll < 50, "30-50")
            .when(scroll < 75, "50-75").when(scroll.isNotNull(), "75-100"))
