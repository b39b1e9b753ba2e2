"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` whole (through the adapters)
and runs the library operators; the final projection follows
``plans.outputs`` so the DuckDB oracle can be compared value by value.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.config import ExperimentConfig, InferenceConfig
from armlens.functions.geo import point, point_in_ring, point_wkt
from armlens.operators import bitmaps as bm
from armlens.operators import inference as inf
from armlens.operators.orders import multiplication
from armlens.operators.skew import split_join
from armlens.operators.wilcoxon import signed_rank_stats
from armlens.operators.zones import ZoneIndex
from armlens.plans import outputs as O
from armlens.plans.incremental import DailyPartials
from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import bounded_broadcast
from armlens.plans.pipeline import ExperimentDAG, Sources, run_pipeline
from armlens.sources import adapters as A
from armlens.plans.tables import TableStore
from armlens.session import ensure_checkpoint_dir
from armlens.sources.tables import Tables

WORLD_CFG = ExperimentConfig(since=A.SINCE, excluded_test_names=(A.EXCLUDED_TEST,))
ORDER_ICFG = InferenceConfig()
EVENT_ICFG = InferenceConfig(kpis=("value_sum",), count_kpi="event_count")
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")  # a line number can repeat
BY_DATE_ICFG = InferenceConfig(pair_on="date")
MATRIX_KPIS = (ORDER_ICFG.count_kpi, *ORDER_ICFG.kpis)
LINE_TIES_ICFG = InferenceConfig(kpis=("price_sum",), count_kpi="line_count", ties_exact=True)
LINE_ICFG = InferenceConfig(kpis=("price_sum",), count_kpi="line_count")

# Fixed test rings for the point-in-polygon query over embedding coordinates.
PIP_RINGS = (
    (1, ((-0.1, -0.1), (0.1, -0.1), (0.1, 0.1), (-0.1, 0.1))),
    (2, ((0.0, 0.0), (0.3, 0.0), (0.3, 0.2), (0.15, 0.05), (0.0, 0.2))),
)


_WORLDS: dict = {}


def world(spark: SparkSession, sf_dir: str) -> A.World:
    """Adapter frames are lazy plans with no data: built once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WORLDS:
        _WORLDS[key] = A.World(Tables(spark, sf_dir))
    return _WORLDS[key]


def dag(spark: SparkSession, sf_dir: str) -> ExperimentDAG:
    return ExperimentDAG(Sources.from_world(world(spark, sf_dir)), WORLD_CFG)


def _stage(name: str, spec, extra=None):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(dag(spark, sf_dir), name)
        if extra:
            df = df.withColumns(extra())
        return O.spark_project(df, spec)
    q.__name__ = name
    return q


def events_experiment(t: Tables) -> DataFrame:
    """Events as a one-test experiment: variant by user parity, KPI = value."""
    e = t.events
    return e.select(
        F.lit("Events").alias("region"), F.lit("EV").alias("entity_id"), F.lit(0).cast("long").alias("test_id"),
        F.lit("events_test").alias("test_name"),
        F.when(F.col("user_id") % 2 == 0, F.lit("Control")).otherwise(F.lit("Variation1")).alias("variant"),
        F.to_date("ts").alias("created_date_utc"), F.col("event_id").cast("string").alias("order_id"),
        F.col("value").cast("decimal(18,2)").alias("value_sum"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("boolean"))
        .otherwise(F.col("event_type").isin("purchase", "signup")).alias("is_in_treatment"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Target Group "), (F.col("user_id") % 3 + 1).cast("string")))
        .alias("target_group_bi"))


def lines_experiment(t: Tables) -> DataFrame:
    """Line items as a one-test experiment: three arms by customer, monthly series."""
    x = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    v = F.col("o_custkey") % 3
    return x.select(
        F.lit("Lines").alias("region"), F.lit("LI").alias("entity_id"), F.lit(1).cast("long").alias("test_id"),
        F.lit("lineitem_test").alias("test_name"),
        F.when(v == 0, F.lit("Control")).when(v == 1, F.lit("Variation1")).otherwise(F.lit("Variation2"))
        .alias("variant"),
        F.to_date(F.date_trunc("month", F.col("l_shipdate"))).alias("created_date_utc"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price_sum"),
        (F.col("l_returnflag") == "R").alias("is_in_treatment"),
        F.lit(None).cast("string").alias("target_group_bi"))


def _orders_cleaned_table(spark, sf_dir):
    """The order table is read three times by the inference chain (date range,
    segment labels, daily KPIs): it is materialised once, as the pipeline does,
    with all rows and the columns that the chain reads."""
    c = ORDER_ICFG
    used = [*c.keys, c.variant_col, c.date_col, c.order_id_col, c.scope_col, c.segment_col, *c.kpis]
    return cut_lineage(dag(spark, sf_dir).orders_cleaned.select(*used), "orders_cleaned", as_table=True)


def _orders_trimmed(spark, sf_dir):
    return inf.trim_boundary_days(inf.retype_kpis(_orders_cleaned_table(spark, sf_dir)), ORDER_ICFG)


def q_orders_kept_exact(spark, sf_dir):
    """FLT-10 / DOM-11 with whole combinations, and T15: only the orders of the right combination."""
    cfg = replace(WORLD_CFG, scheme_match="exact", keep_only="keep_drop_flag")
    orders = ExperimentDAG(Sources.from_world(world(spark, sf_dir)), cfg).orders
    return O.spark_project(orders.withColumns(_wkt_extra()), O.ORDERS)


def q_row_multiplication(spark, sf_dir):
    """T10: rows and distinct orders of every test and variant."""
    orders = dag(spark, sf_dir).orders
    return multiplication(orders, ["entity_id", "test_id", "variant"])


def q_trimmed(spark, sf_dir):
    return O.spark_project(_orders_trimmed(spark, sf_dir), O.TRIMMED)


def q_daily(spark, sf_dir):
    return O.spark_project(inf.daily_kpis(_orders_trimmed(spark, sf_dir), ORDER_ICFG), O.DAILY)


def q_grid(spark, sf_dir):
    tr = _orders_trimmed(spark, sf_dir)
    daily = inf.daily_kpis(tr, ORDER_ICFG)
    return O.spark_project(inf.comparison_grid(daily, inf.segment_values(tr, ORDER_ICFG), ORDER_ICFG), O.GRID)


def q_stats(spark, sf_dir):
    daily = cut_lineage(inf.daily_kpis(_orders_trimmed(spark, sf_dir), ORDER_ICFG), "daily_kpis", as_table=True)
    return O.spark_project(inf.arm_statistics(daily, ORDER_ICFG), O.STATS)


def q_pvalues(spark, sf_dir):
    return O.spark_project(inf.experiment_pvalues(_orders_cleaned_table(spark, sf_dir), ORDER_ICFG), O.PVALUES)


def _reach(rows: DataFrame, icfg: InferenceConfig) -> DataFrame:
    """Distinct orders of every arm and granularity by quarter and over all ('all'), from bitmaps of days."""
    arm = [*icfg.keys, icfg.variant_col]
    cells = bm.order_bitmaps(rows, arm, [icfg.date_col, icfg.scope_col, icfg.segment_col], icfg.order_id_col, icfg.date_col)
    cells = bm.by_granularity(cut_lineage(cells, "order_bitmaps", as_table=True), inf.granularity_labels(icfg))
    day = F.col(icfg.date_col)
    quarter = F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))
    cells = cells.withColumn("period", F.explode(F.array(F.lit("all"), quarter))).where("period is not null")
    return bm.distinct_orders(cells, [*arm, "granularity", "period"])


def q_order_reach(spark, sf_dir):
    return _reach(_orders_trimmed(spark, sf_dir), ORDER_ICFG)


def q_lineitem_reach(spark, sf_dir):
    """Orders whose lines fall on several months count once a quarter and once in all."""
    return _reach(lines_experiment(world(spark, sf_dir).t), LINE_ICFG)


def _partials(spark, sf_dir):
    """Partials brought up to date in two steps: an earlier state of the orders (later days missing, some days
    incomplete, one day since withdrawn), then today's; the second refresh must leave the finished days alone."""
    store = _fresh_store(spark, "partials")
    orders = cut_lineage(inf.retype_kpis(_orders_cleaned_table(spark, sf_dir)), "orders_typed", as_table=True)
    day, half = F.col("created_date_utc"), F.lit("1997-06-01").cast("date")
    early = orders.where((day < half) & ~((F.dayofmonth(day) == 7) & (F.col("order_id").cast("long") % 2 == 0)))
    gone = orders.where(day == half).withColumn("created_date_utc", F.lit("1990-01-01").cast("date"))
    partials = DailyPartials(spark, store.root, ORDER_ICFG, prefix=store.prefix)
    partials.refresh(early.unionByName(gone))
    redone = partials.refresh(orders)
    if any(d.isoformat() < "1997-06-01" and d.day != 7 for d in redone):
        raise RuntimeError("a finished day was recomputed")
    return partials


def q_incremental_daily(spark, sf_dir):
    return O.spark_project(_partials(spark, sf_dir).series(), O.DAILY)


def q_incremental_pvalues(spark, sf_dir):
    return O.spark_project(_partials(spark, sf_dir).pvalues(), O.PVALUES)


def _fresh_store(spark, name):
    mark = uuid.uuid4().hex[:12]
    return TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{mark}", prefix=f"{name}_{mark}_")


def q_saved_daily(spark, sf_dir):
    """SNK-1, SNK-2, SRC-11: the order table saved under a name, replaced by a query that reads it (boundary
    days trimmed), then read by name."""
    store = _fresh_store(spark, "saved")
    store.replace(inf.retype_kpis(dag(spark, sf_dir).orders_cleaned), "orders")
    store.replace(inf.trim_boundary_days(store.table("orders"), ORDER_ICFG), "orders")
    return O.spark_project(inf.daily_kpis(spark.table(f"{store.prefix}orders"), ORDER_ICFG), O.DAILY)


def q_pipeline_pvalues(spark, sf_dir):
    """SRC-13, SNK-3, ORD-1: every stage replaced as a named table, a resumed run that finds nothing to do, and
    the p-values read by name and loaded anew."""
    store = _fresh_store(spark, "run")
    src = Sources.from_world(world(spark, sf_dir))
    run_pipeline(spark, src, store.root, WORLD_CFG, ORDER_ICFG, resume=True, prefix=store.prefix)
    again = run_pipeline(spark, src, store.root, WORLD_CFG, ORDER_ICFG, resume=True, prefix=store.prefix)
    if again.rewritten:
        raise RuntimeError(f"stages ran twice: {again.rewritten}")
    return O.spark_project(store.truncate_and_load(spark.table(f"{store.prefix}pvalues"), "pvalues"), O.PVALUES)


def q_pvalue_matrix(spark, sf_dir):
    p = inf.experiment_pvalues(_orders_cleaned_table(spark, sf_dir), ORDER_ICFG)
    return _rounded(inf.pvalue_matrix(p, MATRIX_KPIS))


def q_pvalue_matrix_filtered(spark, sf_dir):
    """FLT-16: tests and granularities by pattern."""
    p = inf.experiment_pvalues(_orders_cleaned_table(spark, sf_dir), ORDER_ICFG)
    return _rounded(inf.pvalue_matrix(p, MATRIX_KPIS, test_pattern="LB", granularity_pattern="^Exp|^Target"))


def _rounded(matrix):
    return matrix.withColumns({k: F.round(k, 9) for k in MATRIX_KPIS})


def _daily_of(frame_fn, icfg):
    def build(spark, sf_dir):
        """The raw table is read twice, for the date ranges and for the daily series with its labels."""
        tr = inf.trim_boundary_days(frame_fn(world(spark, sf_dir).t), icfg)
        return tr, cut_lineage(inf.daily_kpis(tr, icfg), "daily_kpis", as_table=True)
    return build


def _stats_query(frame_fn, icfg):
    build = _daily_of(frame_fn, icfg)

    def q(spark, sf_dir):
        _, daily = build(spark, sf_dir)
        return O.spark_project(inf.arm_statistics(daily, icfg), O.STATS)
    return q


def _pvalue_query(frame_fn, icfg):
    build = _daily_of(frame_fn, icfg)

    def q(spark, sf_dir):
        tr, daily = build(spark, sf_dir)
        grid = inf.comparison_grid(daily, inf.segment_values(tr, icfg), icfg)
        return O.spark_project(inf.paired_test(daily, grid, icfg), O.PVALUES)
    return q


def q_long_arm_statistics(spark, sf_dir):
    """WIN-3 / WIN-4 / JN-14 on arms as long as the table: every line's price, paired by position, by running
    totals over range partitions."""
    t = world(spark, sf_dir).t
    v = F.col("l_orderkey") % 3
    long = t.lineitem.select(
        F.lit("lines").alias("test_name"), F.lit("Experiment").alias("granularity"), F.lit("price").alias("kpi"),
        F.when(v == 0, F.lit("Control")).when(v == 1, F.lit("Variation1")).otherwise(F.lit("Variation2")).alias("variant"),
        *LINE_ORDER, "l_shipdate",
        F.when(F.col("l_linenumber") == 6, F.lit(None)).otherwise(F.floor(F.col("l_extendedprice") / 100).cast("decimal(38,9)"))
        .alias("value"))
    return O.spark_project(signed_rank_stats(long, order_keys=LINE_ORDER, date_col="l_shipdate"), O.STATS)


def q_pvalues_by_date(spark, sf_dir):
    """JN-14 with ``pair_on="date"``: days that both arms have are paired."""
    return O.spark_project(inf.experiment_pvalues(_orders_cleaned_table(spark, sf_dir), BY_DATE_ICFG), O.PVALUES)


def q_point_in_polygon(spark, sf_dir):
    """JN-9 / FLT-20 on embedding coordinates (dims 1, 2) against fixed rings."""
    rings = F.array(*[F.struct(F.lit(i).cast("long").alias("ring_id"), A._ring(r).alias("ring"))
                      for i, r in PIP_RINGS])
    e = world(spark, sf_dir).t.embeddings.select(
        "vec_id", point(F.col("embedding")[0], F.col("embedding")[1]).alias("p"), F.explode(rings).alias("r"))
    return e.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("r.ring_id").alias("ring_id"),
                    point_in_ring(F.col("r.ring"), F.col("p")).alias("inside"))


def q_skewed_vendor_join(spark, sf_dir):
    """JN-6 with a third of the line items on one vendor and a seventh without one: lines and revenue by vendor."""
    t = world(spark, sf_dir).t
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    lines = t.lineitem.select(
        F.when(n == 7, F.lit(None)).when(k % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey")).cast("string").alias("vendor_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    vendors = world(spark, sf_dir).vendors.where(F.col("vendor_id") % 10 != 3).select("vendor_id", "vertical_parent")
    joined = split_join(cut_lineage(lines, "skewed_lines", as_table=True), vendors, ["vendor_id"], "left")
    return joined.groupBy("vendor_id", "vertical_parent").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("price").cast("double").alias("revenue"))


def q_zone_containment(spark, sf_dir):
    """JN-9 / FLT-20 with holes, islands and parts: the areas of its own country that hold an order's point."""
    t = world(spark, sf_dir).t
    areas = cut_lineage(A.delivery_areas(t), "delivery_areas")
    index = ZoneIndex(areas, ["country_code"], ["area_id"], "shape")
    return index.locate(A.delivery_points(t), "lon", "lat").select("order_id", "country_code", "area_id")


def q_area_lookup(spark, sf_dir):
    """JN-9 without a key: how many areas of any country hold each embedding's point (dims 1, 2, times 40)."""
    t = world(spark, sf_dir).t
    areas = cut_lineage(A.delivery_areas(t), "delivery_areas")
    points = t.embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                                 (F.col("embedding")[0].cast("double") * 40).alias("lon"),
                                 (F.col("embedding")[1].cast("double") * 40).alias("lat"))
    found = ZoneIndex(areas, names=["country_code", "area_id"], shape="shape").locate(points, "lon", "lat")
    return found.groupBy("vec_id").agg(F.count(F.lit(1)).alias("areas"))


def q_point_wkt(spark, sf_dir):
    """SC-16 / SC-17 on embedding coordinates."""
    e = world(spark, sf_dir).t.embeddings
    text = e.select(F.col("vec_id").cast("long").alias("vec_id"),
                    point_wkt(point(F.col("embedding")[0], F.col("embedding")[1])).alias("wkt"))
    return O.spark_project(text, [("vec_id", "i"), ("wkt", "w")])


def q_region_vertical_map(spark, sf_dir):
    """DOM-15 over every vendor: raw parent vertical -> test vocabulary by region."""
    from armlens.functions.verticals import region_vertical
    w = world(spark, sf_dir)
    ent = w.entities.select("region", F.col("platforms")[0]["entity_id"].alias("global_entity_id"))
    v = w.vendors.join(bounded_broadcast(ent), "global_entity_id", "left")
    return v.select("global_entity_id", "vendor_id", "region", F.lower("vertical_parent").alias("vertical_parent"),
                    region_vertical(F.col("region"), F.col("vertical_parent")).alias("vertical_test_equivalent"))


def _wkt_extra():
    return {"customer_location_wkt": point_wkt("customer_location")}


QUERIES = {
    "active_entities": _stage("entities", O.ENTITIES),
    "experiment_select": _stage("valid_tests", O.VALID_TESTS),
    "target_groups": _stage("target_groups", O.TARGET_GROUPS),
    "experiment_zones": _stage("zones", O.ZONES),
    "variants_and_schemes": _stage("variants", O.VARIANTS),
    "scheme_combinations": _stage("scheme_combos", O.SCHEME_COMBOS),
    "zone_shapes": _stage("zone_shapes", O.ZONE_SHAPES, lambda: {"zone_vertices": F.size("zone_shape")}),
    "enriched_orders": _stage("orders", O.ORDERS, _wkt_extra),
    "orders_kept_exact": q_orders_kept_exact,
    "row_multiplication": q_row_multiplication,
    "orders_with_profit": _stage("orders_cleaned", O.ORDERS_CLEANED, _wkt_extra),
    "session_events": _stage("session_events", O.SESSION_EVENTS),
    "session_flags": _stage("session_flags", O.SESSION_FLAGS),
    "sessions_with_flag": _stage("sessions_with_flag", O.SESSIONS_WITH_FLAG),
    "trimmed_orders": q_trimmed,
    "daily_kpis": q_daily,
    "comparison_grid": q_grid,
    "wilcoxon_statistics": q_stats,
    "experiment_pvalues": q_pvalues,
    "order_reach": q_order_reach,
    "lineitem_reach": q_lineitem_reach,
    "incremental_daily_kpis": q_incremental_daily,
    "incremental_pvalues": q_incremental_pvalues,
    "saved_daily_kpis": q_saved_daily,
    "pipeline_pvalues": q_pipeline_pvalues,
    "pvalue_matrix": q_pvalue_matrix,
    "pvalue_matrix_filtered": q_pvalue_matrix_filtered,
    "events_wilcoxon_statistics": _stats_query(events_experiment, EVENT_ICFG),
    "events_pvalues": _pvalue_query(events_experiment, EVENT_ICFG),
    "lineitem_wilcoxon_statistics": _stats_query(lines_experiment, LINE_ICFG),
    "lineitem_pvalues": _pvalue_query(lines_experiment, LINE_ICFG),
    "lineitem_pvalues_ties_exact": _pvalue_query(lines_experiment, LINE_TIES_ICFG),
    "long_arm_statistics": q_long_arm_statistics,
    "pvalues_paired_by_date": q_pvalues_by_date,
    "region_vertical_map": q_region_vertical_map,
    "point_in_polygon": q_point_in_polygon,
    "skewed_vendor_join": q_skewed_vendor_join,
    "zone_containment": q_zone_containment,
    "area_lookup": q_area_lookup,
    "point_wkt": q_point_wkt,
}
