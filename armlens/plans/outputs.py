"""Output specs shared by the Spark queries and their DuckDB oracle.

A spec is a list of ``(column, kind)``; both sides project the same names and
normalise types the same way, so results compare value by value:

  s  string           i  bigint          b  boolean        d  double as is
  m  decimal->double  r  round(double, 4) t  timestamp->text  dt date->text
  p  round(double, 9) w  point text, read back as two doubles
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spark_project(df: DataFrame, spec) -> DataFrame:
    cols = []
    for name, kind in spec:
        c = F.col(name)
        if kind == "i":
            c = c.cast("long")
        elif kind in ("m", "d"):
            c = c.cast("double")
        elif kind == "r":
            c = F.round(c.cast("double"), 4)
        elif kind in ("t", "dt"):
            c = c.cast("string")
        elif kind == "p":
            c = F.round(c, 9)
        elif kind == "w":
            for k, axis in ((1, "lon"), (2, "lat")):
                part = F.regexp_extract(c, r"^POINT\((\S+) (\S+)\)$", k)
                cols.append(F.when(c.isNotNull(), part.cast("double")).alias(f"{name}_{axis}"))
            continue
        cols.append(c.alias(name))
    return df.select(*cols)


def sql_project(spec, source: str) -> str:
    cols = []
    for name, kind in spec:
        q = f'"{name}"'
        if kind == "i":
            e = f"CAST({q} AS BIGINT)"
        elif kind in ("m", "d"):
            e = f"CAST({q} AS DOUBLE)"
        elif kind == "r":
            e = f"round(CAST({q} AS DOUBLE), 4)"
        elif kind in ("t", "dt"):
            e = f"CAST({q} AS VARCHAR)"
        elif kind == "p":
            e = f"round({q}, 9)"
        elif kind == "w":
            cols += [f'"{name}_lon"', f'"{name}_lat"']
            continue
        else:
            e = q
        cols.append(f"{e} AS {q}")
    return "SELECT " + ", ".join(cols) + f" FROM {source}"


ENTITIES = [("region", "s"), ("entity_id", "s"), ("country_iso", "s"), ("country_name", "s")]
VALID_TESTS = [("entity_id", "s"), ("country_code", "s"), ("test_id", "i"), ("test_name", "s")]
TEST = [("entity_id", "s"), ("country_code", "s"), ("test_start_date", "t"), ("test_end_date", "t"),
        ("test_name", "s"), ("test_id", "i")]
TARGET_GROUPS = TEST + [
    ("vendor_group_id", "i"), ("vendor_code", "s"), ("tg_name", "s"), ("tc_id", "i"), ("tc_priority", "i"),
    ("start_at", "t"), ("recurrence_end_at", "t"), ("active_days", "s"), ("cc_id", "i"), ("cc_priority", "i"),
    ("orders_number_less_than", "i"), ("days_since_first_order_less_than", "i"), ("parent_vertical_concat", "s"),
    ("first_parent_vertical", "s"), ("second_parent_vertical", "s"), ("vertical_type", "s")]
ZONES = TEST + [("zone_id", "i")]
VARIANTS = TEST + [("target_group", "s"), ("variant", "s"), ("price_scheme_id", "i")]
SCHEME_COMBOS = [("entity_id", "s"), ("country_code", "s"), ("test_name", "s"), ("test_id", "i"),
                 ("tg_var_scheme_concat", "s")]
ZONE_SHAPES = [("entity_id", "s"), ("country_code", "s"), ("city_name", "s"), ("city_id", "i"),
               ("zone_vertices", "i"), ("zone_name", "s"), ("zone_id", "i"), ("test_name", "s"), ("test_id", "i"),
               ("test_start_date", "t"), ("test_end_date", "t")]
ORDERS = [
    ("created_date_utc", "dt"), ("order_placed_at_utc", "t"), ("order_placed_at_local", "t"), ("dow_local", "s"),
    ("dps_sessionid_created_at_utc", "t"), ("day_num_in_test", "i"), ("region", "s"), ("entity_id", "s"),
    ("country_code", "s"), ("city_name", "s"), ("city_id", "i"), ("zone_name", "s"), ("zone_id", "i"),
    ("customer_location_wkt", "w"), ("variant", "s"), ("test_id", "i"), ("test_name", "s"),
    ("test_start_date", "t"), ("test_end_date", "t"), ("perseus_client_id", "s"), ("ga_session_id", "s"),
    ("dps_sessionid", "s"), ("dps_customer_tag", "s"), ("customer_total_orders", "i"),
    ("customer_first_order_date", "t"), ("days_since_first_order", "i"), ("order_id", "s"),
    ("platform_order_code", "s"), ("scheme_id", "i"), ("vendor_price_scheme_type", "s"), ("vendor_id", "s"),
    ("target_group", "s"), ("target_group_bi", "s"), ("is_in_treatment", "b"), ("chain_id", "s"),
    ("chain_name", "s"), ("vertical_type", "s"), ("vendor_vertical_parent", "s"), ("delivery_status", "s"),
    ("is_own_delivery", "b"), ("exchange_rate", "m"), ("dps_delivery_fee_local", "m"), ("delivery_fee_local", "m"),
    ("delivery_fee_local_incl_disc_and_vouchers", "m"), ("dps_travel_time_fee_local", "m"),
    ("commission_local", "m"), ("joker_vendor_fee_local", "m"), ("service_fee_local", "m"), ("sof_local", "m"),
    ("delivery_costs_local", "m"), ("actual_df_paid_by_customer", "m"), ("gfv_local", "m"), ("gmv_local", "m"),
    ("mean_delay", "d"), ("dps_mean_delay", "d"), ("dps_mean_delay_zone_id", "i"), ("travel_time", "d"),
    ("dps_travel_time", "d"), ("travel_time_distance_km", "d"), ("delivery_distance_m", "d"),
    ("to_customer_time", "d"), ("actual_DT", "d"), ("is_delivery_fee_covered_by_discount", "b"),
    ("is_delivery_fee_covered_by_voucher", "b"), ("parent_vertical_concat", "s"), ("keep_drop_flag", "s"),
    ("keep_drop_flag_bi", "s")]
ORDERS_CLEANED = [c for c in ORDERS] + [("revenue_local", "r"), ("gross_profit_local", "r")]
SESSION_EVENTS = [
    ("created_date", "dt"), ("region", "s"), ("entity_id", "s"), ("country_code", "s"), ("platform", "s"),
    ("brand", "s"), ("events_ga_session_id", "s"), ("fullvisitor_id", "s"), ("visit_id", "s"),
    ("has_transaction", "b"), ("total_transactions", "i"), ("ga_dps_session_id", "s"),
    ("dps_session_timestamp", "t"), ("endpoint", "s"), ("perseus_client_id", "s"), ("variant", "s"),
    ("test_id", "i"), ("is_parallel", "b"), ("parent_vertical_vendor_tbl", "s"),
    ("parent_vertical_test_equivalent", "s"), ("first_parent_vertical_test", "s"),
    ("second_parent_vertical_test", "s"), ("vertical_type", "s"), ("vendor_group_id", "i"),
    ("target_group_bi", "s"), ("customer_status", "s"), ("location", "s"), ("variant_concat", "s"),
    ("location_concat", "s"), ("customer_status_concat", "s"), ("event_action", "s"), ("vendor_code", "s"),
    ("event_time", "t"), ("transaction_id", "s"), ("expedition_type", "s"), ("city_id", "i"), ("city_name", "s"),
    ("zone_id", "i"), ("zone_name", "s"), ("timezone", "s"), ("ga_location", "w"),
    ("is_session_in_treatment_raw", "s")]
SESSION_FLAGS = [("entity_id", "s"), ("test_id", "i"), ("events_ga_session_id", "s"),
                 ("distinct_event_actions_per_session", "s"), ("num_instances_with_treated_vendors", "i"),
                 ("num_instances_with_no_treated_vendors", "i"), ("num_instances_with_unknown_treatment_vendors", "i"),
                 ("is_session_in_treatment_agg", "s")]
SESSIONS_WITH_FLAG = SESSION_EVENTS + [("is_session_in_treatment_agg", "s"), ("test_name", "s")]
KPIS = ("actual_df_paid_by_customer", "dps_travel_time_fee_local", "gfv_local", "gmv_local", "commission_local",
        "revenue_local", "delivery_costs_local", "gross_profit_local")
DAILY = [("region", "s"), ("entity_id", "s"), ("test_id", "i"), ("test_name", "s"), ("granularity", "s"),
         ("variant", "s"), ("created_date_utc", "dt"), ("order_count", "i")] + [(k, "r") for k in KPIS]
TRIMMED = [("region", "s"), ("entity_id", "s"), ("test_id", "i"), ("test_name", "s"), ("variant", "s"),
           ("created_date_utc", "dt"), ("order_id", "s"), ("is_in_treatment", "b"), ("target_group_bi", "s"),
           ("gross_profit_local", "r")]
GRID = [("region", "s"), ("entity_id", "s"), ("test_name", "s"), ("variant", "s"), ("granularity", "s"),
        ("kpi", "s")]
STATS = [("test_name", "s"), ("granularity", "s"), ("kpi", "s"), ("variant", "s"), ("n_x", "i"), ("n_y", "i"),
         ("n_pairs", "i"), ("n_zero", "i"), ("n", "i"), ("w_plus", "d"), ("w_minus", "d"), ("tie_term", "i")]
PVALUES = GRID + [("pval", "p")]
