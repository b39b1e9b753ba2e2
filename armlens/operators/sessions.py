"""Web-session treatment flags (DOM-14 .. DOM-18).

The sessions of the tests are written once, nested, and read twice: for the
target-group numbering (WIN-2, a dense rank over the *distinct* observed
(entity, test, group) triples, joined back, so a large test never lands its
rows in a single window task) and for the events. Shuffles: one DISTINCT over
the flattened event rows (hash over all columns, so no key is hot), one partial
aggregate per session, one join back of the session flags, which splits off NULL
and hot session ids (``operators.skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from armlens.config import ExperimentConfig
from armlens.functions.geo import point_wkt
from armlens.functions.strings import distinct_sorted_string_agg
from armlens.functions.verticals import region_vertical
from armlens.operators.orders import key_set, semi_filter
from armlens.operators.skew import lookup_join, split_join
from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import bounded_broadcast, known_size

# The session event vocabulary.
BROWSING_ACTIONS = ("home_screen.loaded", "shop_list.loaded")
BROWSING_ONLY_SETS = ("home_screen.loaded", "home_screen.loaded, shop_list.loaded", "shop_list.loaded")
NO_GROUP_LABELS = ("Non Target Group", "Unknown")
NULL_GROUP_SENTINEL = 999999

SESSION_KEYS = ("entity_id", "test_id", "events_ga_session_id")

FLAT_COLUMNS = (
    "created_date", "region", "entity_id", "country_code", "platform", "brand", "events_ga_session_id",
    "fullvisitor_id", "visit_id", "has_transaction", "total_transactions", "ga_dps_session_id",
    "dps_session_timestamp", "endpoint", "perseus_client_id", "variant", "test_id", "is_parallel",
    "parent_vertical_vendor_tbl", "parent_vertical_test_equivalent", "first_parent_vertical_test",
    "second_parent_vertical_test", "vertical_type", "vendor_group_id", "target_group_bi", "customer_status",
    "location", "variant_concat", "location_concat", "customer_status_concat", "event_action", "vendor_code",
    "event_time", "transaction_id", "expedition_type", "city_id", "city_name", "zone_id", "zone_name",
    "timezone", "ga_location",
)


def session_group_rank(sessions: DataFrame) -> DataFrame:
    """WIN-2: ``DENSE_RANK() OVER (PARTITION BY entity_id, test_id ORDER BY
    COALESCE(vendor_group_id, 999999))`` on the distinct observed groups, read
    from the nested event arrays (a session without events has a NULL group)."""
    seen = F.array_distinct(F.transform("events", lambda e: F.coalesce(e["vendor_group_id"], F.lit(NULL_GROUP_SENTINEL))))
    groups = (sessions.select("entity_id", "test_id", F.explode_outer(seen).alias("_group_key"))
              .withColumn("_group_key", F.coalesce("_group_key", F.lit(NULL_GROUP_SENTINEL).cast("long"))).distinct())
    w = Window.partitionBy("entity_id", "test_id").orderBy("_group_key")
    return groups.withColumn("_group_rank", F.dense_rank().over(w))


def event_treatment_flag(event_action, target_group_bi) -> F.Column:
    """DOM-16: browsing events are 'Unknown'; other events are 'Y' when they
    touch a target-group vendor, else 'N'; a NULL action gives NULL."""
    a, g = F.col(event_action), F.col(target_group_bi)
    browsing = a.isin(*BROWSING_ACTIONS)
    no_group = g.isin(*NO_GROUP_LABELS)
    return (F.when(browsing, F.lit("Unknown"))
            .when(~browsing & no_group, F.lit("N"))
            .when(~browsing & ~no_group, F.lit("Y")))


def flatten_sessions(ga_sessions: DataFrame, vendors: DataFrame, entities: DataFrame,
                     target_groups: DataFrame, variants: DataFrame,
                     cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-14 + DOM-16: nested sessions -> distinct event x zone rows (41
    columns) plus the event-level treatment flag."""
    bmax = cfg.broadcast_max_rows
    s = F.col
    x = ga_sessions.where(s("created_date") >= F.lit(cfg.since).cast("date")).select(
        "created_date", "entity_id", "country_code", "platform", "brand", "events_ga_session_id", "fullvisitor_id",
        "visit_id", "has_transaction", "total_transactions", "ga_dps_session_id",
        s("sessions.dps_session_timestamp").alias("dps_session_timestamp"),
        s("sessions.endpoint").alias("endpoint"),
        s("sessions.perseus_client_id").alias("perseus_client_id"),
        s("sessions.variant").alias("variant"),
        s("sessions.experiment_id").alias("test_id"),
        s("sessions.is_parallel").alias("is_parallel"),
        s("sessions.customer_status").alias("customer_status"),
        s("sessions.location").alias("location"),
        s("sessions.variant_concat").alias("variant_concat"),
        s("sessions.location_concat").alias("location_concat"),
        s("sessions.customer_status_concat").alias("customer_status_concat"),
        "events", "dps_zone", point_wkt("ga_location").alias("ga_location"))
    x = semi_filter(x, key_set(variants, {"entity_id": "entity_id", "test_id": "test_id", "variant": "variant"}), bmax,
                    known_size(variants))
    x = semi_filter(x, key_set(target_groups, {"entity_id": "entity_id", "test_id": "test_id"}), bmax,
                    known_size(target_groups))

    x = cut_lineage(x, "test_sessions", as_table=True)

    # JN-5: two sibling outer unnests = per-session cross product events x zones.
    keep = [c for c in x.columns if c not in ("events", "dps_zone")]
    ev = x.select(*keep, "dps_zone", F.explode_outer("events").alias("e"))
    ev = ev.select(*keep, "e", F.explode_outer("dps_zone").alias("dps"))
    ev = ev.select(*keep,
                   s("e.vertical_type").alias("vertical_type"), s("e.vendor_group_id").alias("vendor_group_id"),
                   s("e.event_action").alias("event_action"), s("e.vendor_code").alias("vendor_code"),
                   s("e.event_time").alias("event_time"), s("e.transaction_id").alias("transaction_id"),
                   s("e.expedition_type").alias("expedition_type"),
                   s("dps.city_id").alias("city_id"), s("dps.city_name").alias("city_name"),
                   s("dps.id").alias("zone_id"), s("dps.name").alias("zone_name"), s("dps.timezone").alias("timezone"))

    # groups observed per test: counted as they are written, then broadcast, so
    # the exploded events never shuffle on a handful of (test, group) keys
    ranks = bounded_broadcast(cut_lineage(session_group_rank(x), "session_groups"), bmax)
    # JN-6: broadcast when the (3-column) vendor table is proven small, so the
    # exploded event rows are not shuffled just to attach it; else NULL and hot
    # vendor codes are split off the shuffle.
    ven = cut_lineage(vendors.select(F.col("global_entity_id").alias("entity_id"),
                                     F.col("vendor_id").alias("vendor_code"),
                                     F.col("vertical_parent").alias("_vendor_vertical")), "vendor_verticals")
    ent = bounded_broadcast(entities.select("entity_id", "region"), bmax, known_size(entities))
    # test_name of the SQL's DISTINCT sub-select only multiplies rows that the
    # final DISTINCT removes again, so it is left out of the lookup.
    vert = target_groups.select("entity_id", "test_id",
                                F.col("first_parent_vertical").alias("first_parent_vertical_test"),
                                F.col("second_parent_vertical").alias("second_parent_vertical_test")).distinct()
    vert = bounded_broadcast(vert, bmax, known_size(target_groups))

    ev = ev.withColumn("_group_key", F.coalesce(F.col("vendor_group_id"), F.lit(NULL_GROUP_SENTINEL)))
    j = (lookup_join(ev, ven, ["entity_id", "vendor_code"], "left", max_rows=bmax)
         .join(ent, "entity_id", "left")
         .join(vert, ["entity_id", "test_id"], "left")
         .join(ranks, ["entity_id", "test_id", "_group_key"], "left"))
    tg_label = (F.when(s("vendor_group_id").isNull() & s("vendor_code").isNull(), F.lit("Unknown"))
                .when(s("vendor_group_id").isNull() & s("vendor_code").isNotNull(), F.lit("Non Target Group"))
                .otherwise(F.concat(F.lit("Target Group "), s("_group_rank").cast("string"))))
    flat = j.select(*[
        {"parent_vertical_vendor_tbl": F.lower(s("_vendor_vertical")).alias("parent_vertical_vendor_tbl"),
         "parent_vertical_test_equivalent": region_vertical(s("region"), s("_vendor_vertical"))
         .alias("parent_vertical_test_equivalent"),
         "target_group_bi": tg_label.alias("target_group_bi")}.get(c, s(c)) for c in FLAT_COLUMNS
    ]).distinct()
    return flat.withColumn("is_session_in_treatment_raw",
                           event_treatment_flag("event_action", "target_group_bi"))


def session_treatment_flags(flat_events: DataFrame) -> DataFrame:
    """DOM-17: per (entity, test, session) the sorted distinct event actions,
    the Y/N/Unknown event counts and the session flag."""
    raw = F.col("is_session_in_treatment_raw")
    agg = flat_events.groupBy(*SESSION_KEYS).agg(
        distinct_sorted_string_agg("event_action").alias("distinct_event_actions_per_session"),
        F.sum(F.when(raw == "Y", 1).otherwise(0)).cast("long").alias("num_instances_with_treated_vendors"),
        F.sum(F.when(raw == "N", 1).otherwise(0)).cast("long").alias("num_instances_with_no_treated_vendors"),
        F.sum(F.when(raw == "Unknown", 1).otherwise(0)).cast("long")
        .alias("num_instances_with_unknown_treatment_vendors"))
    acts = F.col("distinct_event_actions_per_session")
    browsing_only = acts.isin(*BROWSING_ONLY_SETS)
    return agg.withColumn(
        "is_session_in_treatment_agg",
        F.when(browsing_only, F.lit("Unknown"))
        .when(~browsing_only & (F.col("num_instances_with_treated_vendors") >= 1), F.lit("Y"))
        .otherwise(F.lit("N")))


def attach_session_flag(flat_events: DataFrame, flags: DataFrame, valid_names: DataFrame,
                        cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-18: session flag and test name on every event row (written to a new
    table, never over the table being read, T20). JN-15: rows without a session
    id match nothing and do not shuffle, hot ids meet their flag by broadcast."""
    f = flags if known_size(flags) is not None else cut_lineage(flags, "session_flags", as_table=True)
    f = f.select(*SESSION_KEYS, "is_session_in_treatment_agg")
    names = bounded_broadcast(valid_names.select("entity_id", "test_id", "test_name"), cfg.broadcast_max_rows,
                              known_size(valid_names))
    return (split_join(flat_events, f, SESSION_KEYS, "left", max_rows=cfg.broadcast_max_rows)
            .join(names, ["entity_id", "test_id"], "left")
            .select(*flat_events.columns, "is_session_in_treatment_agg", "test_name"))
