"""DOM-16 / DOM-17 / WIN-2 on hand-made event rows."""
from armlens.operators import sessions as se

SCHEMA = "entity_id string, test_id bigint, events_ga_session_id string, event_action string, " \
         "is_session_in_treatment_raw string"


def test_session_flag_cases(spark):
    rows = [("E", 1, "s1", "home_screen.loaded", "Unknown"), ("E", 1, "s1", "shop_list.loaded", "Unknown"),
            ("E", 1, "s2", "home_screen.loaded", "Unknown"), ("E", 1, "s2", "shop_details.loaded", "Y"),
            ("E", 1, "s3", "shop_details.loaded", "N"),
            ("E", 1, "s4", None, None)]
    out = {r.events_ga_session_id: (r.distinct_event_actions_per_session, r.is_session_in_treatment_agg)
           for r in se.session_treatment_flags(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {"s1": ("home_screen.loaded, shop_list.loaded", "Unknown"),
                   "s2": ("home_screen.loaded, shop_details.loaded", "Y"),
                   "s3": ("shop_details.loaded", "N"),
                   "s4": ("", "N")}


def test_event_flag(spark):
    rows = [("home_screen.loaded", "Target Group 1"), ("checkout.loaded", "Unknown"),
            ("checkout.loaded", "Target Group 2"), (None, "Target Group 2")]
    df = spark.createDataFrame(rows, "event_action string, target_group_bi string")
    out = [r[0] for r in df.select(se.event_treatment_flag("event_action", "target_group_bi")).collect()]
    assert out == ["Unknown", "N", "Y", None]


def test_session_group_rank_nulls_last(spark):
    """Groups of all sessions of a test are ranked together; a NULL group and a session without events come last."""
    rows = [("E", 1, [(None,), (9,)]), ("E", 1, [(7,), (7,), (9,)]), ("E", 2, []), ("E", 3, None), ("E", 4, [(5,)]), ("F", 1, [(8,)])]
    df = spark.createDataFrame(rows, "entity_id string, test_id bigint, events array<struct<vendor_group_id:bigint>>")
    out = {}
    for r in se.session_group_rank(df).collect():
        out.setdefault((r.entity_id, r.test_id), []).append((r._group_rank, r._group_key))
    assert {k: sorted(v) for k, v in out.items()} == {
        ("E", 1): [(1, 7), (2, 9), (3, 999999)], ("E", 2): [(1, 999999)], ("E", 3): [(1, 999999)], ("E", 4): [(1, 5)],
        ("F", 1): [(1, 8)]}


GA_SCHEMA = (
    "created_date date, entity_id string, country_code string, platform string, brand string, "
    "events_ga_session_id string, fullvisitor_id string, visit_id string, has_transaction boolean, "
    "total_transactions bigint, ga_dps_session_id string, ga_location struct<lon:double,lat:double>, "
    "sessions struct<dps_session_timestamp:timestamp, endpoint:string, perseus_client_id:string, variant:string, "
    "experiment_id:bigint, is_parallel:boolean, customer_status:string, location:string, variant_concat:string, "
    "location_concat:string, customer_status_concat:string>, "
    "events array<struct<event_action:string, vendor_group_id:bigint, vendor_code:string, vertical_type:string, "
    "event_time:timestamp, transaction_id:string, expedition_type:string>>, "
    "dps_zone array<struct<city_id:bigint, city_name:string, id:bigint, name:string, timezone:string>>")


def test_flatten_sessions(spark):
    import datetime as dt
    from armlens.config import ExperimentConfig
    day, ts = dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 10)

    def sess(sid, variant, events, zones):
        return (day, "E", "C", "iOS", "B", sid, "fv", "v", False, 0, "g", (1.5, 2.0),
                (ts, "ep", "pc", variant, 5, False, "new", "loc", variant, "loc", "new"), events, zones)

    ev = lambda a, g, v: (a, g, v, None, ts, None, "delivery")
    z = lambda i: (1, "City", i, f"Z{i}", "UTC")
    rows = [sess("s1", "Control", [ev("shop_details.loaded", 9, "v1"), ev("checkout.loaded", None, "v2"),
                                   ev("transaction", 7, "v1")], [z(1), z(2)]),
            sess("s2", "Control", [], [z(1)]),
            sess("s3", "Control", [ev("home_screen.loaded", None, None)], []),
            sess("s4", "Original", [ev("transaction", 7, "v1")], [z(1)])]
    ga = spark.createDataFrame(rows, GA_SCHEMA)
    vendors = spark.createDataFrame([("E", "v1", "Food")], "global_entity_id string, vendor_id string, "
                                                          "vertical_parent string")
    ents = spark.createDataFrame([("Asia", "E")], "region string, entity_id string")
    tg = spark.createDataFrame([("E", "C", "t", 5, "shop", None)],
                               "entity_id string, country_code string, test_name string, test_id bigint, "
                               "first_parent_vertical string, second_parent_vertical string")
    variants = spark.createDataFrame([("E", 5, "Control")], "entity_id string, test_id bigint, variant string")
    out = se.flatten_sessions(ga, vendors, ents, tg, variants, ExperimentConfig(since="2024-01-01")).collect()
    by = {}
    for r in out:
        by.setdefault(r.events_ga_session_id, []).append(r)
    assert set(by) == {"s1", "s2", "s3"}           # s4's variant is not part of the test
    assert len(by["s1"]) == 6                        # 3 events x 2 zones
    labels = {(r.event_action, r.target_group_bi, r.is_session_in_treatment_raw) for r in by["s1"]}
    assert labels == {("shop_details.loaded", "Target Group 2", "Y"), ("checkout.loaded", "Non Target Group", "N"),
                      ("transaction", "Target Group 1", "Y")}
    assert [(r.event_action, r.zone_id, r.is_session_in_treatment_raw) for r in by["s2"]] == [(None, 1, None)]
    assert [(r.target_group_bi, r.zone_id) for r in by["s3"]] == [("Unknown", None)]
    r = [x for x in by["s1"] if x.vendor_code == "v1"][0]
    assert (r.region, r.parent_vertical_vendor_tbl, r.parent_vertical_test_equivalent,
            r.first_parent_vertical_test, r.ga_location) == ("Asia", "food", "restaurant", "shop", "POINT(1.5 2)")
