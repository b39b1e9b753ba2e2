"""Readers for the driver tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Lazy, cached-by-name access to ``{sf_dir}/{name}.parquet``.

    Reads are plain ``spark.read.parquet``: Catalyst prunes columns and pushes
    filters into the scan of whatever the query uses."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    @property
    def _local(self) -> bool:
        return "://" not in self.sf_dir or self.sf_dir.startswith("file:")

    def path(self, name: str) -> str:
        if not self._local:  # object store / HDFS: the driver layout, {name}.parquet
            return f"{self.sf_dir.rstrip('/')}/{name}.parquet"
        p = os.path.join(self.sf_dir, f"{name}.parquet")
        return p if os.path.exists(p) else os.path.join(self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]
