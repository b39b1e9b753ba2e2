"""Daily KPIs, comparison grid and p-values (DOM-19 .. DOM-23).

The notebook downloads the order table into one process, aggregates it four
times and loops over the grid one test at a time. Here the whole chain is one
lazy plan: boundary trim (broadcast of a pre-aggregated date range), one
aggregation pass for all granularities, the grid from the measured label set, and the
signed-rank test as a grouped job; nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.config import InferenceConfig
from armlens.operators.wilcoxon import ARM_KEYS, add_p_values, long_kpis, signed_rank_stats
from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import bounded_broadcast, known_rows, known_size

LABELS_A_ROW = 1000
EXPERIMENT, IN_SCOPE, OUT_OF_SCOPE = "Experiment", "Treatment Scope", "Non-Treatment Scope"


def retype_kpis(df: DataFrame, cols=("test_id", "dps_travel_time_fee_local", "gfv_local", "gmv_local",
                                     "commission_local")) -> DataFrame:
    """PRJ-10: numeric re-typing of the columns the notebook converts; a value
    that does not parse becomes NULL (summed as missing)."""
    present = [c for c in cols if c in df.columns and c != "test_id"]
    return df.withColumns({c: F.col(c).try_cast("decimal(38,9)") for c in present})


def trim_boundary_days(orders: DataFrame, cfg: InferenceConfig = InferenceConfig(),
                       max_rows: int = 2_000_000) -> DataFrame:
    """DOM-19: drop the first and the last day of every test.

    The date range is computed per (region, entity, test id, test name) - a
    partial aggregate, so a test holding a third of all orders is combined map
    side - and joined back on (entity, test id) only (a test with two names or
    regions duplicates its orders, as the notebook's merge does)."""
    d = cfg.date_col
    keys = list(cfg.keys)
    ranges = (orders.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
              .groupBy(*keys).agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))
              .select("entity_id", "test_id", "min_date", "max_date"))
    ranges = cut_lineage(ranges, "test_ranges")  # one row a test, counted as it is written: the broadcast's proof
    joined = orders.join(bounded_broadcast(ranges, max_rows), ["entity_id", "test_id"], "left")
    return joined.where((F.col(d) > F.col("min_date")) & (F.col(d) < F.col("max_date"))).drop("min_date",
                                                                                                 "max_date")


def granularity_labels(cfg: InferenceConfig = InferenceConfig()) -> F.Column:
    """The granularities an order row belongs to (NULL entries removed later)."""
    scope = F.col(cfg.scope_col)
    return F.array(F.lit(EXPERIMENT),
                   F.when(scope == True, F.lit(IN_SCOPE)),  # noqa: E712
                   F.when(scope == False, F.lit(OUT_OF_SCOPE)),  # noqa: E712
                   F.col(cfg.segment_col))


def daily_kpis(trimmed: DataFrame, cfg: InferenceConfig = InferenceConfig()) -> DataFrame:
    """DOM-20 / AGG-7..9: per (keys, granularity, variant, day) the sum of each
    KPI (missing values skipped, all missing -> 0) and the distinct order count.
    Rows with a NULL group key are left out, as a pandas groupby does (T14).

    Facts are aggregated before they multiply by granularity: the sums to one
    row per (day, scope, segment), the orders to one row with the set of their
    granularities; only those are exploded."""
    base = [*cfg.keys, cfg.variant_col, cfg.date_col]
    rows = trimmed.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in base]))
    group = [*cfg.keys, "granularity", cfg.variant_col, cfg.date_col]
    split = [cfg.scope_col, cfg.segment_col]
    sums = rows.groupBy(*base, *split).agg(*[F.sum(k).alias(k) for k in cfg.kpis])
    sums = (sums.select(*base, *cfg.kpis, F.explode(granularity_labels(cfg)).alias("granularity"))
            .where(F.col("granularity").isNotNull())
            .groupBy(*group).agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in cfg.kpis]))
    orders = (rows.where(F.col(cfg.order_id_col).isNotNull()).groupBy(*base, cfg.order_id_col)
              .agg(F.array_distinct(F.flatten(F.collect_set(granularity_labels(cfg)))).alias("_labels")))
    counts = (orders.select(*base, F.explode("_labels").alias("granularity")).where(F.col("granularity").isNotNull())
              .groupBy(*group).agg(F.count(F.lit(1)).alias(cfg.count_kpi)))
    out = sums.join(counts, group, "left").withColumn(cfg.count_kpi, F.coalesce(cfg.count_kpi, F.lit(0)))
    return out.select(*cfg.keys, "granularity", cfg.variant_col, cfg.date_col, cfg.count_kpi, *cfg.kpis)


def segment_values(trimmed: DataFrame, cfg: InferenceConfig = InferenceConfig()) -> DataFrame:
    """Distinct non-NULL segment labels (e.g. 'Target Group 2'), one a row."""
    return trimmed.where(F.col(cfg.segment_col).isNotNull()).select(F.col(cfg.segment_col).alias("granularity")).distinct()


def comparison_grid(daily: DataFrame, segments: DataFrame, cfg: InferenceConfig = InferenceConfig()) -> DataFrame:
    """DOM-21: every non-control arm x granularity x KPI. The labels are measured, dealt to arrays of about
    ``LABELS_A_ROW`` and broadcast within that proven size; an arm is repeated once per array and meets it by
    its number, so beyond the bound the work is spread over the arrays."""
    arms = (daily.where((F.col("granularity") == EXPERIMENT) & (F.col(cfg.variant_col) != cfg.control))
            .select("region", "entity_id", "test_name", cfg.variant_col).distinct())
    own = F.explode(F.array(*[F.lit(g) for g in cfg.granularity_base])).alias("granularity")
    labels = cut_lineage(segments.distinct(), "segment_labels")
    size = known_size(labels)
    rows = 1 + size.rows // LABELS_A_ROW
    packed = labels.groupBy(F.pmod(F.xxhash64("granularity"), F.lit(rows)).alias("_row")).agg(
        F.collect_set("granularity").alias("_labels"))
    met = (arms.withColumn("_row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)).cast("array<bigint>")))
           .join(bounded_broadcast(packed, bound=size), "_row"))
    kpis = F.array(*[F.lit(k) for k in (cfg.count_kpi, *cfg.kpis)])
    arm = ["region", "entity_id", "test_name", cfg.variant_col]
    every = arms.select(*arm, own).unionByName(met.select(*arm, F.explode("_labels").alias("granularity")))
    return every.select(
        "region", "entity_id", "test_name", cfg.variant_col, "granularity", F.explode(kpis).alias("kpi"))


def arm_statistics(daily: DataFrame, cfg: InferenceConfig = InferenceConfig()) -> DataFrame:
    """AGG-12 statistics per (test_name, granularity, kpi, variant). The rows of a measured ``daily`` bound
    every arm."""
    long = long_kpis(daily, (cfg.count_kpi, *cfg.kpis), cfg.keys, cfg.date_col)
    order_keys = [k for k in cfg.keys if k != "test_name"]
    return signed_rank_stats(long, control=cfg.control, pair_on=cfg.pair_on, order_keys=order_keys,
                             date_col=cfg.date_col, rows=known_rows(daily))


def paired_test(daily: DataFrame, grid: DataFrame, cfg: InferenceConfig = InferenceConfig()) -> DataFrame:
    """DOM-22: the grid with one p-value per row (NULL where untestable)."""
    stats = add_p_values(arm_statistics(daily, cfg), pair_on=cfg.pair_on, ties_exact=cfg.ties_exact,
                         exact_max_n=cfg.exact_max_n)
    p = stats.select(*ARM_KEYS, "pval")
    return grid.join(p, list(ARM_KEYS), "left").select(
        "region", "entity_id", "test_name", "variant", "granularity", "kpi", "pval")


def pvalue_matrix(pvals: DataFrame, kpis, test_pattern: str | None = None,
                  granularity_pattern: str | None = None) -> DataFrame:
    """DOM-23 / AGG-11: KPI names pivoted to columns (mean p-value); rows whose
    p-values are all NULL are dropped; optional regex filters (FLT-16). The KPI
    columns are fixed, so the schema does not depend on the data."""
    m = pvals.groupBy("test_name", "variant", "granularity").pivot("kpi", list(kpis)).agg(F.avg("pval"))
    m = m.where(reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNotNull() for k in kpis]))
    if test_pattern:
        m = m.where(F.col("test_name").rlike(test_pattern))
    if granularity_pattern:
        m = m.where(F.col("granularity").rlike(granularity_pattern))
    return m


def experiment_pvalues(orders: DataFrame, cfg: InferenceConfig = InferenceConfig()) -> DataFrame:
    """DOM-19..22 end to end: order table -> long p-value table.

    ``orders`` is read three times (date ranges, segment labels, daily KPIs):
    pass a materialised table (``run_pipeline`` does), not a long lazy plan.
    The daily series is written once and read by the grid and the test."""
    trimmed = trim_boundary_days(retype_kpis(orders), cfg)
    daily = cut_lineage(daily_kpis(trimmed, cfg), "daily_kpis", as_table=True)
    grid = comparison_grid(daily, segment_values(trimmed, cfg), cfg)
    return paired_test(daily, grid, cfg)
