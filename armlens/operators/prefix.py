"""Running totals of groups of any length (WIN-3, WIN-4).

A window puts a whole group into one task. Here the rows are sorted over all
tasks by (group, order), so a long group is many neighbouring partitions. Each
partition sums its part of every group; those sums, one row per partition and
group in it, give the total before each part; inside a part a window runs on.
No task holds more than one range partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import bounded_broadcast


def running_total(df: DataFrame, group, order, value, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` (a column expression, not NULL) over the rows before, in
    ``order`` within ``group``. Rows equal in ``order`` follow in any one order. The sorted rows are written
    as a table once, so that both passes see the same parts."""
    group, order = list(group), list(order)
    keys = [F.col(c) for c in [*group, *order]]
    dealt = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    rows = dealt.sortWithinPartitions(*keys).withColumns({"_value": value, "_at": F.monotonically_increasing_id()})
    rows = cut_lineage(rows, "sorted_rows", as_table=True).withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy(*group, "_part").agg(F.sum("_value").alias("_sum"))
    # one row per partition and group in it
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut_lineage(parts.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum"), "part_sums")
    inside = Window.partitionBy(*group, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    parts = parts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), "_before")
    condition = F.col("_part") == F.col("_p")
    for s in same:
        condition = condition & s
    out = rows.join(bounded_broadcast(parts), condition)
    return out.select(*df.columns, (F.col("_inside") + F.col("_before")).alias(name))
