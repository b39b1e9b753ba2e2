"""Daily KPIs kept up to date by day (AGG-7, AGG-9, DOM-20).

Two partial tables hold, per day, what the KPI series needs of its orders:

* ``kpis``: the rows of ``daily_kpis`` of that day,
* ``facets``: the distinct tests and segment labels of that day, from which the
  date ranges of the tests and the labels of the grid follow.

``refresh`` reads the narrow columns of the orders once to sign every day (rows,
and a sum of row hashes), recomputes the days whose signature is not the stored
one, and overwrites just their partitions (dynamic partition overwrite). The new
signatures are published last, as a named table: a refresh that fails is simply
repeated. Days that lost all their orders stay on disk but have no signature and
are not read.

``series`` trims the boundary days of every test on the partials (DOM-19), so a
new day moves the boundary without touching older days.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.config import InferenceConfig
from armlens.operators import inference as inf
from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import bounded_broadcast
from armlens.plans.tables import TableStore


class DailyPartials:
    """Partials under ``root``; ``prefix`` names the signature table in the catalog."""

    def __init__(self, spark: SparkSession, root: str, cfg: InferenceConfig = InferenceConfig(), prefix: str = ""):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg
        self.store = TableStore(spark, f"{self.root}/signatures", prefix)

    def _signed(self, orders: DataFrame) -> DataFrame:
        c = self.cfg
        used = [*c.keys, c.variant_col, c.order_id_col, c.scope_col, c.segment_col, *c.kpis]
        return orders.where(F.col(c.date_col).isNotNull()).groupBy(F.col(c.date_col).alias("day")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*used).cast("decimal(20,0)")).alias("hashes"))

    def refresh(self, orders: DataFrame) -> list:
        """Bring the partials to the state of ``orders`` (a table: it is read twice); the days recomputed."""
        c = self.cfg
        signed = cut_lineage(self._signed(orders), "day_signatures")  # a row a day
        changed = signed
        if self.store.current("days") is not None:
            old = self.store.table("days").select("day", F.col("rows").alias("_rows"), F.col("hashes").alias("_hashes"))
            same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("hashes").eqNullSafe(F.col("_hashes"))
            changed = signed.join(old, "day", "left").where(~same).select(*signed.columns)
        changed = cut_lineage(changed.select("day"), "changed_days")
        days = sorted(r.day for r in changed.collect())  # a row a day
        if days:
            fresh = orders.join(bounded_broadcast(changed.withColumnRenamed("day", c.date_col)), c.date_col, "left_semi")
            self._write(inf.daily_kpis(fresh, c), "kpis")
            self._write(fresh.select(*c.keys, c.date_col, c.segment_col).distinct(), "facets")
        if days or self.store.current("days") is None or signed.count() != self.store.current("days").rows:
            self.store.replace(signed, "days")
        return days

    def _write(self, df: DataFrame, name: str) -> None:
        day = self.cfg.date_col
        (df.repartition(F.col(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(day).parquet(f"{self.root}/{name}"))

    def _read(self, name: str) -> DataFrame:
        day = self.cfg.date_col
        days = self.store.table("days").select(F.col("day").alias(day))
        held = self.spark.read.parquet(f"{self.root}/{name}").withColumn(day, F.col(day).cast("date"))
        return held.join(bounded_broadcast(days, bound=self.store.current("days").rows), day, "left_semi")

    def ranges(self) -> DataFrame:
        """First and last day of every test."""
        keys, day = list(self.cfg.keys), self.cfg.date_col
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        found = self._read("facets").where(known).groupBy(*keys).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
        return cut_lineage(found.select(F.col("entity_id").alias("_entity"), F.col("test_id").alias("_test"), "_first", "_last"),
                           "partial_ranges")

    def _trimmed(self, df: DataFrame, ranges: DataFrame) -> DataFrame:
        """Rows of inner days, once per range that covers them (a test with two names has two ranges, T10)."""
        day = F.col(self.cfg.date_col)
        inner = (F.col("entity_id") == F.col("_entity")) & (F.col("test_id") == F.col("_test"))
        return df.join(bounded_broadcast(ranges), inner).where((day > F.col("_first")) & (day < F.col("_last")))

    def series(self) -> DataFrame:
        """``daily_kpis`` of the trimmed orders."""
        c = self.cfg
        group = [*c.keys, "granularity", c.variant_col, c.date_col]
        rows = self._trimmed(self._read("kpis"), self.ranges())
        out = rows.groupBy(*group).agg(F.max(c.count_kpi).alias(c.count_kpi), *[F.sum(k).alias(k) for k in c.kpis])
        return out.select(*c.keys, "granularity", c.variant_col, c.date_col, c.count_kpi, *c.kpis)

    def segments(self) -> DataFrame:
        """``segment_values`` of the trimmed orders."""
        return inf.segment_values(self._trimmed(self._read("facets"), self.ranges()), self.cfg)

    def pvalues(self) -> DataFrame:
        daily = cut_lineage(self.series(), "partial_series", as_table=True)
        return inf.paired_test(daily, inf.comparison_grid(daily, self.segments(), self.cfg), self.cfg)
