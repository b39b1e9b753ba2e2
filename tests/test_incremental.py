"""AGG-7..9, DOM-20: bitmaps of orders merge by OR; partials of days follow the orders."""
import datetime as dt
import os
import random
import re
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from armlens.config import InferenceConfig
from armlens.operators import bitmaps as bm
from armlens.operators import inference as inf
from armlens.plans.incremental import DailyPartials
from armlens.plans.materialize import cut_lineage

CFG = InferenceConfig(kpis=("gfv_local",))
SCHEMA = ("region string, entity_id string, test_id long, test_name string, variant string, created_date_utc date, "
          "order_id string, gfv_local decimal(18,4), is_in_treatment boolean, target_group_bi string")


def order_rows(seed, n=600, days=20, first=dt.date(2024, 1, 1)):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        test = rnd.choice([1, 1, 1, 2, None])
        out.append((rnd.choice(["Asia", "Asia", None]), "E", test, f"t{test}" if rnd.random() < 0.97 else None,
                    rnd.choice(["Control", "Variation1", None]), first + dt.timedelta(days=rnd.randrange(days)),
                    rnd.choice([None, *[f"o{rnd.randrange(150)}"] * 20]),
                    rnd.choice([None, *[rnd.randrange(1000)] * 9]), rnd.choice([True, False, None]),
                    rnd.choice([None, "Target Group 1", "Target Group 2"])))
    return out


def frame(spark, rows):
    from decimal import Decimal
    rows = [(*r[:7], None if r[7] is None else Decimal(r[7]), *r[8:]) for r in rows]
    return cut_lineage(spark.createDataFrame(rows, SCHEMA).repartition(3), "orders", as_table=True)


def same(a, b):
    assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("rows_per_share", [1_000_000, 20])
def test_bitmaps_count_distinct_orders_of_any_union(spark, rows_per_share):
    orders = frame(spark, order_rows(1) * 2)
    arm = ["entity_id", "test_id", "variant"]
    cells = bm.order_bitmaps(orders, arm, ["created_date_utc", "is_in_treatment"], rows_per_share=rows_per_share)
    cells = cut_lineage(cells, "cells", as_table=True)
    known = orders.where("order_id is not null and entity_id is not null and test_id is not null and variant is not null")
    for by in (arm, [*arm, "is_in_treatment"], [*arm, "created_date_utc"]):
        same(bm.distinct_orders(cells, by), known.groupBy(*by).agg(F.countDistinct("order_id").alias("orders")))
    week = F.date_trunc("week", "created_date_utc").cast("date")
    same(bm.distinct_orders(cells.withColumn("week", week), [*arm, "week"]),
         known.withColumn("week", week).groupBy(*arm, "week").agg(F.countDistinct("order_id").alias("orders")))


def test_ids_shuffle_once(spark):
    orders = frame(spark, order_rows(2, 100))
    cells = bm.order_bitmaps(orders, ["entity_id", "test_id", "variant"], ["created_date_utc"])
    counted = bm.distinct_orders(cells, ["entity_id", "test_id", "variant"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert len([x for x in exchanges if "share" in x and "bucket" not in x]) == 1
    assert not any(re.search(r"(?<![a-z])_id#", x.split("hashpartitioning")[1]) for x in exchanges)
    # a bucket holds many orders: numbers of an arm and day lie close together
    assert cells.count() <= 2.5 * orders.select("entity_id", "test_id", "variant", "created_date_utc").distinct().count()


def test_bitmaps_of_nothing(spark):
    orders = frame(spark, order_rows(3, 10)).where("false")
    cells = bm.order_bitmaps(orders, ["entity_id"], ["created_date_utc"])
    assert cells.count() == 0 and bm.distinct_orders(cells, ["entity_id"]).count() == 0


def full(orders):
    trimmed = inf.trim_boundary_days(orders, CFG)
    daily = inf.daily_kpis(trimmed, CFG)
    return daily, inf.segment_values(trimmed, CFG)


def check(partials, orders):
    daily, segments = full(orders)
    same(partials.series(), daily.withColumn("gfv_local", F.col("gfv_local").cast(partials.series().schema["gfv_local"].dataType)))
    same(partials.segments(), segments)


@pytest.fixture()
def partials(spark):
    return DailyPartials(spark, tempfile.mkdtemp(prefix="armlens-partials-"), CFG, prefix=f"p{uuid.uuid4().hex[:8]}_")


def written(partials):
    out = {}
    for folder, _, files in os.walk(f"{partials.root}/kpis"):
        for f in files:
            if f.endswith(".parquet"):
                out.setdefault(os.path.basename(folder), set()).add(f)
    return out


def test_partials_follow_the_orders(spark, partials):
    rows = order_rows(4)
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    early = [r for r in rows if r[5] < day(12)]
    orders = frame(spark, early)
    assert partials.refresh(orders) == sorted({r[5] for r in early})
    check(partials, orders)
    before = written(partials)
    assert partials.refresh(orders) == [] and written(partials) == before
    # later days, one late order on an old day, one value corrected, one day withdrawn
    late = (rows[0][0], "E", 1, "t1", "Control", day(3), "late", 5, True, None)
    now = [r for r in rows if r[5] != day(6)] + [late]
    k = next(i for i, r in enumerate(now) if r[5] == day(8) and r[7] is not None)
    now[k] = (*now[k][:7], now[k][7] + 1, *now[k][8:])
    orders = frame(spark, now)
    again = partials.refresh(orders)
    assert again == sorted({day(3), day(8)} | {r[5] for r in rows if r[5] >= day(12)})
    check(partials, orders)
    kept = {f"created_date_utc={day(d)}" for d in (0, 1, 2, 4, 5, 7, 9, 10, 11)}
    assert all(written(partials)[p] == before[p] for p in kept if p in before)


def test_a_failed_refresh_is_repeated(spark, partials, monkeypatch):
    orders = frame(spark, order_rows(5))
    partials.refresh(orders)
    more = frame(spark, order_rows(5) + order_rows(6, 50))

    def broken(*a, **k):
        raise RuntimeError("midway")
    with monkeypatch.context() as m:
        m.setattr(partials.store, "replace", broken)
        with pytest.raises(RuntimeError, match="midway"):
            partials.refresh(more)
    assert partials.refresh(more) != []
    check(partials, more)


def test_two_names_of_a_test_double_the_sums_but_not_the_counts(spark, partials):
    """T10: the date ranges join on (entity, test id) only."""
    rows = [("Asia", "E", 1, n, "Control", dt.date(2024, 1, d), f"o{d}{n}", 10, True, None) for d in range(1, 8) for n in ("a", "b")]
    orders = frame(spark, rows)
    partials.refresh(orders)
    check(partials, orders)
    assert {(r.order_count, float(r.gfv_local)) for r in partials.series().collect()} == {(1, 20.0)}


def test_grid_beyond_one_label_row(spark, monkeypatch):
    daily, segments = full(frame(spark, order_rows(7)))
    one = inf.comparison_grid(daily, segments, CFG)
    monkeypatch.setattr(inf, "LABELS_A_ROW", 1)
    many = inf.comparison_grid(daily, segments, CFG)
    same(one, many)
    none = inf.comparison_grid(daily, segments.where("false"), CFG)
    assert {r[0] for r in none.select("granularity").distinct().collect()} == {"Experiment", "Treatment Scope", "Non-Treatment Scope"}
