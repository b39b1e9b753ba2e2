"""Experiment dimension build (DOM-1 .. DOM-7).

Inputs follow the source schemas of FIXTURES.md §1; each function returns a
lazy DataFrame equal to the corresponding warehouse table of the reference
pipeline. The setups table is small and read several times: callers that run
the whole DAG materialise it once (see ``plans.pipeline``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from armlens.config import ExperimentConfig
from armlens.functions.strings import sorted_string_agg
from armlens.functions.verticals import first_parent_vertical, second_parent_vertical
from armlens.plans.sizing import bounded_broadcast, known_size

TEST_COLS = ("entity_id", "country_code", "test_start_date", "test_end_date", "test_name", "test_id")


def active_entities(entities: DataFrame, order_fact: DataFrame,
                    cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-1: region of every entity that has orders, minus excluded entities.

    ``LEFT JOIN UNNEST(platforms)`` = explode_outer; the inner join to the
    distinct order entities is a semi join (no row multiplication)."""
    ent = entities.select("region", F.explode_outer("platforms").alias("p"), "country_iso", "country_name")
    ent = ent.select("region", F.col("p.entity_id").alias("entity_id"), "country_iso", "country_name")
    e = F.col("entity_id")
    keep = reduce(lambda a, b: a & b,
                  [~e.like(p) for p in cfg.excluded_entity_patterns] + [~e.isin(*cfg.excluded_entity_ids)])
    with_orders = order_fact.select("entity_id").distinct()  # partial aggregate before the shuffle
    return ent.where(keep).join(with_orders, "entity_id", "left_semi").select(
        "region", "entity_id", "country_iso", "country_name")


def select_experiments(setups: DataFrame, cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-2: valid (entity, country, test id, test name) combinations."""
    name = F.lower(F.col("test_name"))
    any_pattern = reduce(lambda a, b: a | b, [name.like(p) for p in cfg.name_patterns])
    not_excluded = reduce(lambda a, b: a & b, [F.col("test_name") != n for n in cfg.excluded_test_names])
    return (setups
            .where((F.to_date("test_start_date") >= F.lit(cfg.since).cast("date")) & any_pattern & not_excluded)
            .select("entity_id", "country_code", "test_id", "test_name")
            .distinct())


def _valid_setups(setups: DataFrame, valid_names: DataFrame, cfg: ExperimentConfig) -> DataFrame:
    """FLT-7: ``test_name IN (SELECT DISTINCT test_name FROM valid)`` as a semi join."""
    names = valid_names.select("test_name").distinct()
    return setups.join(bounded_broadcast(names, cfg.broadcast_max_rows, known_size(valid_names)),
                       "test_name", "left_semi")


def target_group_rank(setups_with_vendors: DataFrame) -> DataFrame:
    """WIN-1: ``CONCAT('TG', DENSE_RANK() OVER (PARTITION BY entity_id, test_name
    ORDER BY vendor_group_id))`` (NULL group first).

    Ranked on the distinct (entity, test, group) set: dense rank ignores
    duplicates, so this equals ranking the exploded rows, without putting a
    large test's rows into one window task."""
    groups = setups_with_vendors.select("entity_id", "test_name", "vendor_group_id").distinct()
    w = Window.partitionBy("entity_id", "test_name").orderBy(F.col("vendor_group_id").asc_nulls_first())
    return groups.withColumn("tg_name", F.concat(F.lit("TG"), F.dense_rank().over(w).cast("string")))


def _null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])
    out = left.join(right, cond, how)
    return out.select(*[left[c] for c in left.columns], *[right[c] for c in right.columns if c not in keys])


def target_groups(setups: DataFrame, valid_names: DataFrame, vendors: DataFrame,
                  cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-3: one row per test x target group x vendor x time/customer condition
    x active day, with the sorted list of parent verticals, its first/second
    canonical label (DOM-4) and the vendor's vertical type."""
    s = _valid_setups(setups, valid_names, cfg)
    s = s.where(F.size("matching_vendor_ids") > 0)  # CROSS JOIN UNNEST drops empty/NULL arrays
    ranks = target_group_rank(s)
    base = [F.col(c) for c in TEST_COLS] + [F.col("vendor_group_id")]
    rows = (s.select(*base, F.explode("matching_vendor_ids").alias("vendor_code"),
                     "test_vertical_parents", "schedule", "customer_condition")
            .select(*base, "vendor_code", F.explode_outer("test_vertical_parents").alias("parent_vertical"),
                    "schedule", "customer_condition")
            .select(*base, "vendor_code", "parent_vertical",
                    F.col("schedule.id").alias("tc_id"),
                    F.col("schedule.priority").alias("tc_priority"),
                    F.col("schedule.start_at").alias("start_at"),
                    F.col("schedule.recurrence_end_at").alias("recurrence_end_at"),
                    F.explode_outer("schedule.active_days").alias("active_days"),
                    F.col("customer_condition.id").alias("cc_id"),
                    F.col("customer_condition.priority").alias("cc_priority"),
                    F.col("customer_condition.orders_number_less_than").alias("orders_number_less_than"),
                    F.col("customer_condition.days_since_first_order_less_than")
                    .alias("days_since_first_order_less_than")))
    # at most one rank row per setup row
    rows = _null_safe_join(rows, bounded_broadcast(ranks, cfg.broadcast_max_rows, known_size(setups)),
                           ["entity_id", "test_name", "vendor_group_id"], "left")
    group_cols = list(TEST_COLS) + ["vendor_group_id", "vendor_code", "tg_name", "tc_id", "tc_priority",
                                    "start_at", "recurrence_end_at", "active_days", "cc_id", "cc_priority",
                                    "orders_number_less_than", "days_since_first_order_less_than"]
    # DISTINCT followed by the string aggregate == one aggregate over a set.
    agg = rows.groupBy(*group_cols).agg(
        F.array_join(F.array_sort(F.collect_set("parent_vertical")), ", ").alias("parent_vertical_concat"))
    agg = agg.withColumns({
        "first_parent_vertical": first_parent_vertical("parent_vertical_concat"),
        "second_parent_vertical": second_parent_vertical("parent_vertical_concat"),
    })
    # The vendor dimension can be large: it is first reduced to the test vendors
    # (semi join), then attached; both joins are sized by AQE at run time.
    ven = vendors.select(F.col("global_entity_id").alias("entity_id"),
                         F.col("vendor_id").alias("vendor_code"), "vertical_type")
    keys = agg.select("entity_id", "vendor_code").distinct()
    ven = ven.join(keys, ["entity_id", "vendor_code"], "left_semi")
    return agg.join(ven, ["entity_id", "vendor_code"], "left").select(*group_cols, "parent_vertical_concat",
                                                                       "first_parent_vertical",
                                                                       "second_parent_vertical", "vertical_type")


def experiment_zones(setups: DataFrame, valid_names: DataFrame,
                     cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-5: distinct zones of the valid tests that have matching vendors.

    The vendor and vertical unnests of the SQL only prove the vendor list is
    non-empty (the result is DISTINCT and carries no vendor): ``size() > 0``."""
    s = _valid_setups(setups, valid_names, cfg).where(F.size("matching_vendor_ids") > 0)
    return s.select(*TEST_COLS, F.explode("zone_ids").alias("zone_id")).distinct()


def variants_and_schemes(setups: DataFrame, valid_names: DataFrame,
                         cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-6 (4.1): distinct target group (by priority) x variant x price scheme per test."""
    s = _valid_setups(setups, valid_names, cfg).where(F.size("matching_vendor_ids") > 0)
    return s.select(*TEST_COLS,
                    F.concat(F.lit("TG"), F.col("priority").cast("string")).alias("target_group"),
                    F.col("variation_group").alias("variant"),
                    "price_scheme_id").distinct()


def scheme_combinations(variants: DataFrame) -> DataFrame:
    """DOM-6 (4.2): per test, the ', '-joined 'TG | variant | scheme' list
    (sorted for determinism; NULL parts drop the element) and the same as an array."""
    combo = F.concat(F.col("target_group"), F.lit(" | "), F.col("variant"), F.lit(" | "),
                     F.col("price_scheme_id").cast("string"))
    return variants.groupBy("entity_id", "country_code", "test_name", "test_id").agg(
        sorted_string_agg(combo).alias("tg_var_scheme_concat"),
        F.array_sort(F.collect_list(combo)).alias("tg_var_scheme_list"))


def zone_shapes(countries: DataFrame, zones: DataFrame,
                cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-7: polygon of every active zone (in an active city) of a test.

    The nested unnests are outer joins in the SQL, but the active-flag
    predicates and the inner join reject their NULL rows, so plain explodes
    give the same rows."""
    co = (countries
          .select("country_code", F.explode("platforms").alias("p"), "cities")
          .select("country_code", F.col("p.entity_id").alias("entity_id"), F.explode("cities").alias("ci"))
          .where(F.col("ci.is_active"))
          .select("entity_id", "country_code", F.col("ci.name").alias("city_name"), F.col("ci.id").alias("city_id"),
                  F.explode("ci.zones").alias("zo"))
          .where(F.col("zo.is_active"))
          .select("entity_id", "country_code", "city_name", "city_id",
                  F.col("zo.shape").alias("zone_shape"), F.col("zo.name").alias("zone_name"),
                  F.col("zo.id").alias("zone_id")))
    tgt = zones.select("entity_id", "country_code", "zone_id", "test_name", "test_id",
                       "test_start_date", "test_end_date")
    tgt = bounded_broadcast(tgt, cfg.broadcast_max_rows, known_size(zones))
    return co.join(tgt, ["entity_id", "country_code", "zone_id"]).select(
        "entity_id", "country_code", "city_name", "city_id", "zone_shape", "zone_name", "zone_id",
        "test_name", "test_id", "test_start_date", "test_end_date")
