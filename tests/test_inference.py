"""DOM-19 .. DOM-23 properties (T14, additivity, grid shape, trim)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from armlens.config import InferenceConfig
from armlens.operators import inference as inf

CFG = InferenceConfig(kpis=("gfv_local",))
SCHEMA = ("region string, entity_id string, test_id bigint, test_name string, variant string, "
          "created_date_utc date, order_id string, gfv_local decimal(18,4), is_in_treatment boolean, "
          "target_group_bi string")


def orders(spark):
    rows = []
    for day in range(1, 6):
        for i, (variant, scope, tg) in enumerate([("Control", True, "Target Group 1"), ("V1", False, None),
                                                  ("V1", None, "Target Group 2"), ("Control", False, None)]):
            rows.append(("R", "E", 1, "t", variant, dt.date(2024, 1, day), f"o{day}-{i}", Decimal(day * i + i * i),
                         scope, tg))
    return spark.createDataFrame(rows, SCHEMA)


def test_trim_drops_first_and_last_day(spark):
    tr = inf.trim_boundary_days(orders(spark), CFG)
    assert sorted({r.created_date_utc.day for r in tr.collect()}) == [2, 3, 4]


def test_granularities_and_null_scope(spark):
    daily = inf.daily_kpis(orders(spark), CFG)
    by = {(r.granularity, r.variant, r.created_date_utc.day): r for r in daily.collect()}
    # NULL scope (T14) only counts in Experiment
    assert by[("Experiment", "V1", 1)].order_count == 2
    assert by[("Non-Treatment Scope", "V1", 1)].order_count == 1
    assert ("Treatment Scope", "V1", 1) not in by
    # additivity: experiment = in scope + out of scope when the flag is set
    c_exp = by[("Experiment", "Control", 3)].gfv_local
    c_in, c_out = by[("Treatment Scope", "Control", 3)].gfv_local, by[("Non-Treatment Scope", "Control", 3)].gfv_local
    assert c_exp == c_in + c_out
    assert by[("Target Group 2", "V1", 2)].gfv_local == Decimal(2 * 2 + 4)


def test_grid_and_pvalues(spark):
    o = orders(spark)
    daily = inf.daily_kpis(o, CFG)
    grid = inf.comparison_grid(daily, inf.segment_values(o, CFG), CFG)
    assert grid.count() == 1 * (3 + 2) * 2  # one arm x (3 + 2 segments) x (count + 1 KPI)
    p = inf.paired_test(daily, grid, CFG)
    got = {(r.granularity, r.kpi): r.pval for r in p.collect()}
    assert got[("Experiment", "gfv_local")] is not None
    assert got[("Target Group 1", "gfv_local")] is None  # the arm has no such segment


def test_pvalue_matrix_drops_all_null_rows(spark):
    p = spark.createDataFrame([("t", "V1", "Experiment", "a", 0.5), ("t", "V1", "TG", "a", None)],
                              "test_name string, variant string, granularity string, kpi string, pval double")
    m = inf.pvalue_matrix(p, ("a", "b"), test_pattern="^t$")
    rows = m.collect()
    assert len(rows) == 1 and rows[0]["a"] == 0.5 and rows[0]["b"] is None


def test_trim_duplicates_orders_of_a_test_with_two_names(spark):
    # T10: the date range is keyed by (region, entity, test id, test name) but
    # joined back on (entity, test id): a second name duplicates the orders
    base = orders(spark)
    both = base.unionByName(base.withColumn("test_name", F.lit("t2")))  # same test id, second name
    plain = inf.trim_boundary_days(base, CFG).count()
    # twice the input rows, each matching both (identical) date ranges
    assert inf.trim_boundary_days(both, CFG).count() == 4 * plain
