"""DOM-1 .. DOM-7 on hand-made setups (JN-2/3, WIN-1 / T6, AGG-1/2, T17)."""
import datetime as dt

from armlens.config import ExperimentConfig
from armlens.operators import experiments as ex

SETUP_SCHEMA = (
    "entity_id string, country_code string, test_id bigint, test_name string, test_start_date timestamp, "
    "test_end_date timestamp, vendor_group_id bigint, priority bigint, price_scheme_id bigint, "
    "variation_group string, matching_vendor_ids array<string>, zone_ids array<bigint>, "
    "test_vertical_parents array<string>, "
    "schedule struct<id:bigint,priority:bigint,start_at:timestamp,recurrence_end_at:timestamp,"
    "active_days:array<string>>, "
    "customer_condition struct<id:bigint,priority:bigint,orders_number_less_than:bigint,"
    "days_since_first_order_less_than:bigint>")
START = dt.datetime(2023, 1, 1)


def setup_row(group, vendors, verticals=("Shop", "darkstores"), zones=(1,), variant="Control", name="x_lb",
              days=None, priority=1):
    sched = (None, None, None, None, list(days) if days else None)
    return ("E1", "C1", 10, name, START, START, group, priority, 100 + priority, variant, list(vendors),
            list(zones), list(verticals), sched, (None, None, None, None))


def frames(spark, rows):
    setups = spark.createDataFrame(rows, SETUP_SCHEMA)
    valid = ex.select_experiments(setups, ExperimentConfig(since="2022-11-28"))
    vendors = spark.createDataFrame([("E1", "v1", "restaurants")],
                                    "global_entity_id string, vendor_id string, vertical_type string")
    return setups, valid, vendors


def test_target_group_rank_nulls_first(spark):
    rows = [setup_row(None, ["v1"]), setup_row(7, ["v2"]), setup_row(9, ["v3"]), setup_row(9, ["v3"])]
    setups, valid, vendors = frames(spark, rows)
    tg = ex.target_groups(setups, valid, vendors).select("vendor_group_id", "tg_name").distinct().collect()
    assert sorted((r.vendor_group_id or -1, r.tg_name) for r in tg) == [(-1, "TG1"), (7, "TG2"), (9, "TG3")]


def test_target_groups_explodes(spark):
    rows = [setup_row(1, ["v1", "v2"], days=["MONDAY", "TUESDAY"]), setup_row(2, [])]
    setups, valid, vendors = frames(spark, rows)
    tg = ex.target_groups(setups, valid, vendors).collect()
    # inner unnest of vendors drops the empty list; outer unnest of days keeps both
    assert sorted((r.vendor_code, r.active_days) for r in tg) == [
        ("v1", "MONDAY"), ("v1", "TUESDAY"), ("v2", "MONDAY"), ("v2", "TUESDAY")]
    r = [x for x in tg if x.vendor_code == "v1"][0]
    assert (r.parent_vertical_concat, r.first_parent_vertical, r.second_parent_vertical, r.vertical_type) == (
        "Shop, darkstores", "shop", "darkstores", "restaurants")


def test_no_verticals_keeps_row_with_empty_concat(spark):
    setups, valid, vendors = frames(spark, [setup_row(1, ["v9"], verticals=())])
    r = ex.target_groups(setups, valid, vendors).first()
    assert (r.parent_vertical_concat, r.first_parent_vertical, r.vertical_type) == ("", None, None)


def test_zones_need_vendors_and_names(spark):
    rows = [setup_row(1, ["v1"], zones=(1, 2)), setup_row(2, [], zones=(3,)),
            setup_row(1, ["v1"], zones=(4,), name="other")]
    setups, valid, _ = frames(spark, rows)
    assert sorted(r.zone_id for r in ex.experiment_zones(setups, valid).collect()) == [1, 2]


def test_scheme_combinations(spark):
    rows = [setup_row(1, ["v1"], variant="Control", priority=1), setup_row(1, ["v1"], variant="V1", priority=1),
            setup_row(2, ["v2"], variant="Control", priority=2)]
    setups, valid, _ = frames(spark, rows)
    v = ex.variants_and_schemes(setups, valid)
    r = ex.scheme_combinations(v).first()
    assert r.tg_var_scheme_concat == "TG1 | Control | 101, TG1 | V1 | 101, TG2 | Control | 102"


def test_select_experiments_filters(spark):
    rows = [setup_row(1, ["v"], name="A_LB_x"), setup_row(1, ["v"], name="plain"),
            setup_row(1, ["v"], name="DK_20221213_R_B0_O_Aalborg")]
    setups = spark.createDataFrame(rows, SETUP_SCHEMA)
    out = ex.select_experiments(setups, ExperimentConfig(since="2022-11-28")).collect()
    assert [r.test_name for r in out] == ["A_LB_x"]


def test_active_entities(spark):
    ent = spark.createDataFrame([("Europe", "DE", "Germany", [("FP_DE",), ("E1",), ("DN5",), ("ODR1",)])],
                                "region string, country_iso string, country_name string, "
                                "platforms array<struct<entity_id:string>>")
    orders = spark.createDataFrame([("E1",), ("FP_DE",), ("DN5",)], "entity_id string")
    out = ex.active_entities(ent, orders).collect()
    assert [r.entity_id for r in out] == ["E1"]  # 'DN5' matches LIKE 'DN_%'


def test_zone_shapes_active_flags(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    zone = lambda i, active: (i, f"Z{i}", active, ring)
    countries = spark.createDataFrame(
        [("C1", [("E1",)], [(1, "City1", True, [zone(1, True), zone(2, False)]),
                            (2, "City2", False, [zone(3, True)])])],
        "country_code string, platforms array<struct<entity_id:string>>, "
        "cities array<struct<id:bigint, name:string, is_active:boolean, zones:array<struct<id:bigint, name:string, "
        "is_active:boolean, shape:array<struct<lon:double,lat:double>>>>>>")
    zones = spark.createDataFrame([("E1", "C1", START, START, "t", 10, z) for z in (1, 2, 3, 4)],
                                  "entity_id string, country_code string, test_start_date timestamp, "
                                  "test_end_date timestamp, test_name string, test_id bigint, zone_id bigint")
    out = ex.zone_shapes(countries, zones).collect()
    # zone 2 is inactive, zone 3 is in an inactive city, zone 4 has no shape
    assert [(r.zone_id, r.city_name, len(r.zone_shape)) for r in out] == [(1, "City1", 3)]


def test_empty_platforms_and_start_date_bound(spark):
    ent = spark.createDataFrame([("Asia", "X1", "x", []), ("Asia", "X2", "y", None), ("Asia", "X3", "z", [("E3",)])],
                                "region string, country_iso string, country_name string, "
                                "platforms array<struct<entity_id:string>>")
    orders = spark.createDataFrame([("E3",), (None,)], "entity_id string")
    assert [r.entity_id for r in ex.active_entities(ent, orders).collect()] == ["E3"]  # NULL entity never joins
    early = setup_row(1, ["v"], name="early_lb")
    early = early[:4] + (dt.datetime(2022, 11, 27, 23, 0),) + early[5:]
    setups = spark.createDataFrame([early, setup_row(1, ["v"], name="late_lb")], SETUP_SCHEMA)
    names = [r.test_name for r in ex.select_experiments(setups, ExperimentConfig(since="2022-11-28")).collect()]
    assert names == ["late_lb"]
