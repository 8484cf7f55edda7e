"""Lazy parquet access to the driver tables.

Each table is read with ``spark.read.parquet``; no schema inference beyond
parquet's own footer, and no action is run.  Column pruning and predicate
pushdown reach the scan because every consumer is a DataFrame plan.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Named parquet tables under one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BASE_TABLES:
            raise AttributeError(name)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            path = os.path.join(self.sf_dir, f"{name}.parquet")
            self._frames[name] = self.spark.read.parquet(path)
        return self._frames[name]

    @cached_property
    def base(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in BASE_TABLES}

    def view(self, name: str) -> DataFrame:
        """A reference-schema table derived from the driver tables (FIXTURES)."""
        from aislekit.sources.adapters import adapter_frame

        key = f"view:{name}"
        if key not in self._frames:
            self._frames[key] = adapter_frame(self, name)
        return self._frames[key]
