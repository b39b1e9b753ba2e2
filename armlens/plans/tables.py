"""Named tables that are replaced as a whole (SNK-1, SNK-2, SNK-3).

A version of a table is a parquet folder of its own, ``<root>/<name>/<version>``,
and is never changed. Replacing a table

1. writes the new version to its fresh folder, counting rows and bytes,
2. appends one line to the log ``<root>/_log`` (JSON, one file a line),
3. points the name in the session catalog at the new folder
   (``CREATE OR REPLACE VIEW name AS SELECT * FROM parquet...``).

A reader sees the old version or the new one. A job that fails before step 2
leaves the old version current, in this session and in every other; a table can
be replaced by a query that reads it, since its old files stay. The name is a
view because the catalog switches a view at once and with any schema, while a
table's location and columns change in separate steps.

The log is the truth: the catalog of a session without a metastore starts empty,
``attach`` names every current version again. Lines are numbered by the clock, so
the last publication of a name counts; one writer at a time.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from armlens.plans.materialize import write_counted
from armlens.plans.sizing import Size, with_size

_LOG = "seq long, name string, version string, fingerprint string, rows long, bytes long, columns string"


@dataclass(frozen=True)
class Version:
    seq: int
    name: str
    version: str
    fingerprint: str | None
    rows: int
    bytes: int
    columns: str


class TableStore:
    """Tables under ``root`` (a folder that driver and executors share), named ``<prefix><name>`` in the catalog."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self._current: dict[str, Version] | None = None

    # -- log ---------------------------------------------------------------------------------------------------

    def history(self) -> DataFrame:
        """All versions ever published, one a row."""
        spark = self.spark
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_log")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], _LOG)
        return spark.read.schema(_LOG).json(f"{self.root}/_log")

    def refresh(self) -> dict[str, Version]:
        """Current versions by name, read from the log (as many rows as tables were published)."""
        latest = self.history().selectExpr("name", "struct(seq, version, fingerprint, rows, bytes, columns) as v").groupBy(
            "name").agg({"v": "max"}).toDF("name", "v")
        self._current = {r.name: Version(r.v.seq, r.name, r.v.version, r.v.fingerprint, r.v.rows, r.v.bytes, r.v.columns)
                         for r in latest.collect()}
        return self._current

    def current(self, name: str) -> Version | None:
        return (self.refresh() if self._current is None else self._current).get(name)

    def _path(self, v: Version) -> str:
        return f"{self.root}/{v.name}/{v.version}"

    def _publish(self, name: str, version: str, fingerprint: str | None, size: Size, columns: str) -> Version:
        known = self.refresh() if self._current is None else self._current
        seq = max(time.time_ns(), 1 + max((x.seq for x in known.values()), default=0))
        v = Version(seq, name, version, fingerprint, size.rows, size.bytes, columns)
        self.spark.createDataFrame([(v.seq, name, version, fingerprint, size.rows, size.bytes, columns)], _LOG).coalesce(
            1).write.mode("append").json(f"{self.root}/_log")
        known[name] = v
        return v

    # -- tables ------------------------------------------------------------------------------------------------

    def _point(self, v: Version) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.prefix}{v.name}` AS SELECT * FROM parquet.`{self._path(v)}`")

    def attach(self) -> list[str]:
        """Name every current version in this session's catalog."""
        for v in self.refresh().values():
            self._point(v)
        return sorted(self.prefix + name for name in self._current)

    def table(self, name: str) -> DataFrame:
        """The current version by its catalog name, with its proven size."""
        v = self.current(name)
        if v is None:
            raise KeyError(f"no table {name} under {self.root}")
        if not self.spark.catalog.tableExists(self.prefix + name):
            self._point(v)
        return with_size(self.spark.table(self.prefix + name), Size(v.rows, v.bytes))

    def replace(self, df: DataFrame, name: str, order_by=(), fingerprint: str | None = None) -> DataFrame:
        """SNK-1 / SNK-2: create or replace; ``df`` may read the table it replaces. ``order_by``: file layout."""
        if order_by:
            df = df.sortWithinPartitions(*order_by)
        version = uuid.uuid4().hex
        size = write_counted(df, f"{self.root}/{name}/{version}")
        self._point(self._publish(name, version, fingerprint, size, _columns(df)))
        return self.table(name)

    def truncate_and_load(self, df: DataFrame, name: str) -> DataFrame:
        """SNK-3: new rows for an existing table; its columns and types must stay as they are."""
        v = self.current(name)
        if v is None:
            raise KeyError(f"no table {name} under {self.root}")
        if v.columns != _columns(df):
            raise ValueError(f"columns of {name} are {v.columns}, not {_columns(df)}")
        return self.replace(df, name, fingerprint=v.fingerprint)

    def superseded(self) -> list[str]:
        """Folders of versions that are no longer current (for a cleaning job; readers may still use them)."""
        held = {v.version for v in self.refresh().values()}
        old = self.history().select("name", "version").distinct().collect()
        return sorted(f"{self.root}/{r.name}/{r.version}" for r in old if r.version not in held)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
