"""Adapters: driver tables -> the nine experiment source schemas (FIXTURES.md §1).

The driver ships TPC-H-style tables, not marketplace experiment tables. These
adapters derive an experiment "world" from them with pure column rules, so
that every operator runs on data that grows with the driver tables, and so the
DuckDB oracle can repeat the same rules in SQL (``plans/oracle.py``):

* entity / country: one per nation; region names mapped onto the experiment
  regions (AFRICA has none -> NULL region);
* one test per nation; target groups = suppliers of the nation grouped by
  ``s_suppkey % 3`` (NULL group when ``s_suppkey % 7 = 0``), three variants each;
* order fact = lineitem x orders x customer (one row per line item), money as
  decimal(18,4); variant from ``o_custkey % 3``;
* a session = a user's day; its events come in several rows of bounded arrays
  that share the session id and the values of the whole session;
* zone shapes = three literal polygons per country (a square, a triangle and a
  concave pentagon) and order locations on a 0.1-spaced grid, so containment,
  boundary exclusion and inactive zones all occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.sources.tables import Tables

# Fixed values of the adapter world.
REGION_NAMES = {"EUROPE": "Europe", "ASIA": "Asia", "MIDDLE EAST": "MENA", "AMERICA": "Americas"}
VARIANTS = ("Control", "Variation1", "Variation2")
WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY")
EVENT_ACTIONS = {"view": "home_screen.loaded", "click": "shop_list.loaded", "signup": "shop_details.loaded",
                 "error": "checkout.loaded", "purchase": "transaction"}
SINCE = "1995-03-01"
VENDOR_CHUNK = 1024       # vendors per setup row
EVENT_ROW_BLOCK = 256     # event ids per source row: bounds a row's event array, not the session
EXCLUDED_TEST = "NATION_9_LB_north"
SQUARE = ((0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0))
TRIANGLE = ((5.0, 0.0), (10.0, 0.0), (10.0, 10.0))
BAND = ((0.0, 5.0), (10.0, 5.0), (10.0, 10.0), (0.0, 10.0))
# Shapes of several rings: a square with a hole and an island in it; two parts, one of them a triangle;
# two squares that share a side (the side is an edge of both, so it is outside).
ISLAND = (((0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (0.0, 6.0)), ((1.5, 1.5), (4.5, 1.5), (4.5, 4.5), (1.5, 4.5)),
          ((2.5, 2.5), (3.5, 2.5), (3.5, 3.5), (2.5, 3.5)))
PARTS = (((6.0, 0.0), (9.75, 0.5), (9.0, 4.0)), ((6.5, 6.0), (9.5, 6.0), (9.5, 9.25), (8.0, 7.0), (6.5, 9.25)))
HALVES = (((0.0, 6.5), (2.5, 6.5), (2.5, 9.0), (0.0, 9.0)), ((2.5, 6.5), (5.0, 6.5), (5.0, 9.0), (2.5, 9.0)))
CONCAVE = ((0.0, 5.0), (10.0, 5.0), (10.0, 10.0), (5.0, 7.0), (0.0, 10.0))

c = F.col


def _s(x) -> Column:
    return (c(x) if isinstance(x, str) else x).cast("string")


def entity_of(n) -> Column:
    """Nations 7, 15, 23 get 'DN<n>' ids (excluded by the 'DN_%' rule)."""
    return F.when(c(n) % 8 == 7, F.concat(F.lit("DN"), _s(n))).otherwise(F.concat(F.lit("E"), _s(n)))


def country_of(n) -> Column:
    return F.concat(F.lit("C"), _s(n))


def test_of(n) -> Column:
    return (F.lit(1000) + c(n)).cast("long")


def region_of(r_name) -> Column:
    out = F.lit(None).cast("string")
    for k, v in reversed(list(REGION_NAMES.items())):
        out = F.when(c(r_name) == k, F.lit(v)).otherwise(out)
    return out


def _struct(**fields) -> Column:
    """struct with explicit field names (aliases inside ``struct`` are dropped
    when the same projection holds a generator)."""
    return F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), v)])


def _ring(points) -> Column:
    return F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in points])


def _dec(x, scale_type="decimal(18,4)") -> Column:
    return x.cast(scale_type)


def entities(t: Tables) -> DataFrame:
    n = t.nation.join(t.region, c("n_regionkey") == c("r_regionkey"))
    return n.select(region_of("r_name").alias("region"), country_of("n_nationkey").alias("country_iso"),
                    c("n_name").alias("country_name"),
                    F.array(F.struct(entity_of("n_nationkey").alias("entity_id")),
                            F.struct(F.concat(F.lit("ODR"), _s("n_nationkey")).alias("entity_id")))
                    .alias("platforms"))


def experiment_setups(t: Tables) -> DataFrame:
    g = F.when(c("s_suppkey") % 7 == 0, F.lit(None)).otherwise(c("s_suppkey") % 3).cast("long")
    # at most VENDOR_CHUNK vendors per setup row: a large target group becomes
    # several rows, which every consumer explodes and de-duplicates anyway
    grp = (t.supplier.select("s_suppkey", c("s_nationkey").alias("n"), g.alias("g"),
                             F.expr(f"s_suppkey div {VENDOR_CHUNK}").alias("_chunk"))
           .groupBy("n", "g", "_chunk").agg(F.array_sort(F.collect_list(_s("s_suppkey"))).alias("matching_vendor_ids"))
           .drop("_chunk"))
    nat = t.nation.select(c("n_nationkey").alias("n"), "n_name")
    s = grp.join(nat, "n")
    n = c("n")
    suffix = (F.when(n % 4 == 0, F.lit("_holdout")).when(n % 4 == 1, F.lit("_LB_north"))
              .when(n % 4 == 2, F.lit("_lovedbrands")).otherwise(F.lit("_Lb_south")))
    priority = (F.coalesce(c("g"), F.lit(3)) + 1).cast("long")
    verticals = (F.when(n % 5 == 0, F.array(F.lit("Restaurant")))
                 .when(n % 5 == 1, F.array(F.lit("darkstores"), F.lit("Shop")))
                 .when(n % 5 == 2, F.array().cast("array<string>"))
                 .when(n % 5 == 3, F.array(F.lit("restaurant"), F.lit("Shop"), F.lit("darkstores")))
                 .otherwise(F.array(F.lit("restaurants"), F.lit("shop"))))
    zones = (F.when(n % 3 == 0, F.array(F.lit(1), F.lit(2))).when(n % 3 == 1, F.array(F.lit(1), F.lit(2), F.lit(3)))
             .otherwise(F.array(F.lit(2)))).cast("array<bigint>")
    ts = lambda v: F.lit(v).cast("timestamp")
    schedule = _struct(
        id=c("g"), priority=c("g"),
        start_at=F.when(c("g") == 1, ts("1995-01-01 00:00:00")).when(c("g") == 2, ts("1996-01-01 00:00:00")),
        recurrence_end_at=F.when(c("g") == 1, ts("2000-12-31 00:00:00")).when(c("g") == 2, ts("2001-06-30 00:00:00")),
        active_days=F.when(c("g") == 1, F.array(*[F.lit(d) for d in WEEKDAYS])))
    customer = _struct(
        id=c("g"), priority=c("g"),
        orders_number_less_than=F.when(c("g") == 0, F.lit(5)).when(c("g") == 2, F.lit(10)).cast("long"),
        days_since_first_order_less_than=F.when(c("g") == 2, F.lit(400)).cast("long"))
    base = s.select(
        entity_of("n").alias("entity_id"), country_of("n").alias("country_code"), test_of("n").alias("test_id"),
        F.concat(c("n_name"), suffix).alias("test_name"),
        F.when(n % 6 == 5, ts("1994-06-01 00:00:00")).otherwise(ts("1995-03-01 09:30:00")).alias("test_start_date"),
        ts("2001-12-31 00:00:00").alias("test_end_date"),
        c("g").alias("vendor_group_id"), priority.alias("priority"),
        "matching_vendor_ids", zones.alias("zone_ids"), verticals.alias("test_vertical_parents"),
        schedule.alias("schedule"), customer.alias("customer_condition"),
        F.posexplode(F.array(*[F.lit(v) for v in VARIANTS])).alias("_vidx", "variation_group"))
    return base.withColumn("price_scheme_id", (F.lit(100) + c("priority") * 10 + c("_vidx")).cast("long")).drop("_vidx")


def vendors(t: Tables) -> DataFrame:
    k = c("s_suppkey")
    return t.supplier.select(
        entity_of("s_nationkey").alias("global_entity_id"), _s(k).alias("vendor_id"),
        F.when(k % 4 == 0, F.lit("restaurants")).when(k % 4 == 1, F.lit("Shop")).when(k % 4 == 2, F.lit("darkstores"))
        .alias("vertical_type"),
        F.when(k % 5 == 0, F.lit("Food")).when(k % 5 == 1, F.lit("Local Store")).when(k % 5 == 2, F.lit("dmarts"))
        .when(k % 5 == 3, F.lit("Courier")).alias("vertical_parent"))


def session_orders(t: Tables) -> DataFrame:
    """Orders meet customers first, without their lines: the wide lines shuffle once, on the order key."""
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    cu = t.customer.select("c_custkey", "c_nationkey")
    geo = t.nation.join(t.region, c("n_regionkey") == c("r_regionkey")).select(
        c("n_nationkey").alias("c_nationkey"), region_of("r_name").alias("_region"))
    placed_by = o.join(cu, c("o_custkey") == c("c_custkey")).join(
        F.broadcast(geo), "c_nationkey")  # 25 nations by definition of the table: never a shuffle of the fact on them
    x = li.join(placed_by, c("l_orderkey") == c("o_orderkey"))
    k, ln, sk = c("l_orderkey"), c("l_linenumber"), c("l_suppkey")
    # narrow decimals keep every product within 18 digits (64-bit arithmetic)
    price, disc = c("l_extendedprice").cast("decimal(9,2)"), c("l_discount").cast("decimal(4,2)")
    tax, qty = c("l_tax").cast("decimal(4,2)"), c("l_quantity").cast("decimal(6,2)")
    placed = F.timestamp_add("MINUTE", (k % 24) * 60 + ln * 7, c("l_shipdate").cast("timestamp"))
    vidx = c("o_custkey") % 3
    scheme = F.lit(100) + ((sk % 3) + 1) * 10 + vidx
    variant = (F.when(c("o_custkey") % 11 == 0, F.lit("Original"))
               .when(vidx == 0, F.lit("Control")).when(vidx == 1, F.lit("Variation1")).otherwise(F.lit("Variation2")))
    zone_id = ((k % 3) + 1).cast("long")
    return x.select(
        F.to_date("l_shipdate").alias("created_date"),
        placed.alias("order_placed_at"),
        F.timestamp_add("MINUTE", F.lit(180), placed).alias("order_placed_at_local"),
        F.timestamp_add("MINUTE", F.lit(-5), placed).alias("dps_sessionid_created_at"),
        # customer history as column rules (no per-customer window, so no hot customer task)
        F.when(c("c_custkey") % 13 == 0, F.lit(None).cast("timestamp"))
        .otherwise(F.timestamp_add("DAY", -(c("o_orderkey") % 400), c("o_orderdate").cast("timestamp")))
        .alias("customer_first_order_date"),
        c("_region").alias("region"), entity_of("c_nationkey").alias("entity_id"),
        country_of("c_nationkey").alias("country_code"),
        F.concat(F.lit("City"), _s(c("c_custkey") % 5)).alias("city_name"), (c("c_custkey") % 5).alias("city_id"),
        F.concat(F.lit("Zone"), _s(zone_id)).alias("zone_name"), zone_id.alias("zone_id"),
        variant.alias("variant"),
        F.when(c("o_orderkey") % 9 + 1 <= 3, F.lit("New")).otherwise(F.lit("Existing")).alias("dps_customer_tag"),
        (F.when(ln % 3 == 0, F.lit("Automatic")).when(ln % 3 == 1, F.lit("Manual")).otherwise(F.lit("Campaign"))
         .alias("vendor_price_scheme_type")),
        _s(sk).alias("vendor_id"), F.concat(F.lit("CH"), _s(sk % 10)).alias("chain_id"),
        F.concat(F.lit("Chain "), _s(sk % 10)).alias("chain_name"),
        F.when(sk % 4 == 0, F.lit("restaurants")).when(sk % 4 == 1, F.lit("Shop"))
        .when(sk % 4 == 2, F.lit("darkstores")).alias("vertical_type"),
        F.when(sk % 4 == 0, F.lit("Restaurant")).when(sk % 4 == 1, F.lit("shop"))
        .when(sk % 4 == 2, F.lit("darkstores")).alias("vendor_vertical_parent"),
        F.when(c("l_returnflag") == "R", F.lit("cancelled")).otherwise(F.lit("completed")).alias("delivery_status"),
        test_of("c_nationkey").alias("experiment_id"),
        (F.when(ln == 4, F.floor(scheme / 10)).when(ln == 5, F.lit(999)).otherwise(scheme)).cast("long")
        .alias("scheme_id"),
        (c("o_orderkey") % 9 + 1).cast("long").alias("customer_total_orders"),
        (k % 7).cast("long").alias("dps_mean_delay_zone_id"),
        F.concat(F.lit("PC"), _s("o_custkey")).alias("perseus_client_id"),
        F.concat(F.lit("GA"), _s(k)).alias("ga_session_id"), F.concat(F.lit("DS"), _s(k)).alias("dps_sessionid"),
        _s(k).alias("order_id"), F.concat(F.lit("P"), _s(k)).alias("platform_order_code"),
        F.when(ln % 3 == 0, F.lit(True)).when(ln % 3 == 1, F.lit(False)).alias("is_in_treatment"),
        F.when(k % 9 == 0, F.lit(None).cast("boolean")).otherwise(k % 4 != 0).alias("is_own_delivery"),
        (c("o_orderstatus") != "P").alias("is_sent"),
        (c("l_discount") >= 0.09).alias("is_delivery_fee_covered_by_discount"),
        F.when(c("l_tax") == 0, F.lit(True)).when(c("l_tax") >= 0.08, F.lit(None).cast("boolean"))
        .otherwise(F.lit(False)).alias("is_delivery_fee_covered_by_voucher"),
        F.lit(1).cast("decimal(18,4)").alias("exchange_rate"),
        _dec(price * disc).alias("dps_delivery_fee_local"),
        _dec(price * disc).alias("delivery_fee_local"),
        _dec(qty).alias("dps_travel_time_fee_local"),
        F.when(ln == 7, F.lit(None)).otherwise(_dec(price * F.lit(0.1).cast("decimal(3,2)")))
        .cast("decimal(18,4)").alias("commission_local"),
        F.when(k % 5 == 0, _dec(qty * F.lit(0.5).cast("decimal(3,2)")))
        .otherwise(F.lit(0).cast("decimal(18,4)")).cast("decimal(18,4)").alias("joker_vendor_fee_local"),
        F.when(ln % 2 == 0, F.lit(None)).otherwise(_dec(tax * 100)).cast("decimal(18,4)").alias("service_fee_local"),
        _dec(disc * 10).alias("mov_customer_fee_local"),
        _dec(qty).alias("delivery_costs_local"),
        _dec(price).alias("gfv_local"),
        _dec(price + price * tax).alias("gmv_local"),
        (c("l_quantity") / 10.0).alias("mean_delay"), (c("l_quantity") / 10.0 + 1).alias("dps_mean_delay"),
        c("l_quantity").alias("travel_time"), (c("l_quantity") + 1).alias("dps_travel_time"),
        (c("l_discount") * 100).alias("travel_time_distance_km"),
        (c("l_extendedprice") / 10).alias("delivery_distance_m"),
        (c("l_tax") * 100).alias("to_customer_time"), (c("l_quantity") + 10).alias("actual_DT"),
    )


def ab_test_orders(t: Tables) -> DataFrame:
    k = c("o_orderkey")
    x = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    return x.select(
        entity_of("c_nationkey").alias("entity_id"), _s(k).alias("order_id"),
        F.concat(F.lit("P"), _s(k)).alias("platform_order_code"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Target Group "), _s(k % 4 + 1))).alias("target_group"),
        F.when(k % 97 == 0, F.lit(-1).cast("decimal(9,4)"))
        .otherwise((k % 20).cast("decimal(9,4)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(9,4)")
        .alias("vat_ratio"))


def shared_orders(t: Tables) -> DataFrame:
    """Every order; one in 17 has no known delivery location (NULL struct)."""
    k = c("o_orderkey")
    x = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    loc = F.struct(((k * 37) % 100 / 10.0).alias("longitude"), ((k * 53) % 100 / 10.0).alias("latitude"))
    return x.select(
        entity_of("c_nationkey").alias("global_entity_id"), F.concat(F.lit("P"), _s(k)).alias("order_id"),
        F.when(k % 17 != 0, loc).alias("delivery_location"))


def fee_override_orders(t: Tables) -> DataFrame:
    """One row per (order, ship day); the override fee is known for one order
    in six (orders divisible by 3 but not by 6), NULL otherwise. Rows are made distinct by the order key,
    which the code names, where the join has put them: the lines shuffle once."""
    placed_by = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    x = t.lineitem.join(placed_by, c("l_orderkey") == c("o_orderkey"))
    k = c("l_orderkey")
    fee = (c("o_totalprice").cast("decimal(11,2)") * F.lit(0.001).cast("decimal(4,3)")).cast("decimal(18,4)")
    own = x.select(
        entity_of("c_nationkey").alias("global_entity_id"), k, F.to_date("l_shipdate").alias("created_date_utc"),
        F.when((k % 3 == 0) & (k % 6 != 0), fee).alias("delivery_fee_local")).distinct()
    return own.select("global_entity_id", F.concat(F.lit("P"), _s(k)).alias("code"), "created_date_utc",
                      "delivery_fee_local")


def countries(t: Tables) -> DataFrame:
    def zone(i, name, active, ring):
        return F.struct(F.lit(i).cast("long").alias("id"), F.lit(name).alias("name"),
                        (active if isinstance(active, Column) else F.lit(active)).alias("is_active"),
                        _ring(ring).alias("shape"))
    n = c("n_nationkey")
    city1 = F.struct(F.lit(1).cast("long").alias("id"), F.lit("City1").alias("name"), F.lit(True).alias("is_active"),
                     F.array(zone(1, "Z1", True, SQUARE), zone(2, "Z2", True, TRIANGLE),
                             zone(3, "Z3", False, BAND)).alias("zones"))
    city2 = F.struct(F.lit(2).cast("long").alias("id"), F.lit("City2").alias("name"), (n % 2 == 0).alias("is_active"),
                     F.array(zone(3, "Z3b", True, CONCAVE)).alias("zones"))
    return t.nation.select(country_of("n_nationkey").alias("country_code"),
                           F.array(F.struct(entity_of("n_nationkey").alias("entity_id"))).alias("platforms"),
                           F.array(city1, city2).alias("cities"))


def delivery_areas(t: Tables) -> DataFrame:
    """Three areas of several rings per country, moved by a quarter unit per nation number modulo 4."""
    move = (c("n_nationkey") % 4) * 0.25

    def shape(rings):
        return F.array(*[F.array(*[F.struct((F.lit(x) + move).alias("lon"), (F.lit(y) + move).alias("lat")) for x, y in r])
                         for r in rings])
    areas = F.array(*[F.struct(F.lit(i).cast("long").alias("area_id"), shape(r).alias("shape"))
                      for i, r in enumerate((ISLAND, PARTS, HALVES), 1)])
    return t.nation.select(country_of("n_nationkey").alias("country_code"), F.explode(areas).alias("a")).select(
        "country_code", "a.area_id", "a.shape")


def delivery_points(t: Tables) -> DataFrame:
    """Every order's country and drop-off point (one order in 17 has none)."""
    k = c("o_orderkey")
    x = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    return x.select(k.cast("long").alias("order_id"), country_of("c_nationkey").alias("country_code"),
                    F.when(k % 17 != 0, (k * 37) % 100 / 10.0).alias("lon"), ((k * 53) % 100 / 10.0).alias("lat"))


def ga_sessions(t: Tables) -> DataFrame:
    e = t.events.join(t.customer.select("c_custkey", "c_nationkey"), c("user_id") == c("c_custkey"))
    et, eid, u = c("event_type"), c("event_id"), c("user_id")
    action = F.lit(None).cast("string")
    for k, v in reversed(list(EVENT_ACTIONS.items())):
        action = F.when(et == k, F.lit(v)).otherwise(action)
    browsing = et.isin("view", "click")
    event = F.struct(
        action.alias("event_action"),
        F.when(browsing | (eid % 7 == 0), F.lit(None)).otherwise(eid % 3).cast("long").alias("vendor_group_id"),
        F.when(et == "view", F.lit(None)).otherwise(_s(eid % 100)).alias("vendor_code"),
        F.when(browsing, F.lit(None)).otherwise(F.lit("restaurants")).alias("vertical_type"),
        c("ts").cast("timestamp").alias("event_time"),
        F.when(et == "purchase", F.concat(F.lit("T"), _s(eid))).alias("transaction_id"),
        F.when(eid % 2 == 0, F.lit("delivery")).otherwise(F.lit("pickup")).alias("expedition_type"))
    day = F.to_date("ts")
    block = F.expr(f"event_id div {EVENT_ROW_BLOCK}")
    keys = [u.alias("user_id"), c("c_nationkey"), day.alias("created_date")]
    rows = e.groupBy(*keys, block.alias("_block")).agg(F.collect_list(event).alias("events"))
    whole = e.groupBy(*keys).agg(  # values of the whole session
        F.min(c("ts").cast("timestamp")).alias("_first_ts"),
        F.max((et == "purchase").cast("int")).alias("_has_tx"),
        F.sum((et == "purchase").cast("long")).alias("total_transactions"))
    g = rows.join(whole, ["user_id", "c_nationkey", "created_date"])

    def dzone(i):
        return F.struct(F.lit(1).cast("long").alias("city_id"), F.lit("City1").alias("city_name"),
                        F.lit(i).cast("long").alias("id"), F.lit(f"Z{i}").alias("name"),
                        F.lit("UTC").alias("timezone"))
    u = c("user_id")
    variant = (F.when(u % 13 == 0, F.lit("Original")).when(u % 2 == 0, F.lit("Control"))
               .otherwise(F.lit("Variation1")))
    status = F.when(u % 4 == 0, F.lit("new")).otherwise(F.lit("existing"))
    sid = F.concat(_s(u), F.lit("-"), _s("created_date"))
    return g.select(
        "created_date", entity_of("c_nationkey").alias("entity_id"), country_of("c_nationkey").alias("country_code"),
        F.when(u % 3 == 0, F.lit("iOS")).when(u % 3 == 1, F.lit("Android")).otherwise(F.lit("Web")).alias("platform"),
        F.concat(F.lit("Brand"), _s(c("c_nationkey") % 3)).alias("brand"),
        sid.alias("events_ga_session_id"), F.concat(F.lit("FV"), _s(u)).alias("fullvisitor_id"),
        F.concat(F.lit("V"), sid).alias("visit_id"), (c("_has_tx") == 1).alias("has_transaction"),
        "total_transactions", F.concat(F.lit("GD"), sid).alias("ga_dps_session_id"),
        F.struct(c("_first_ts").alias("dps_session_timestamp"), F.lit("ep").alias("endpoint"),
                 F.concat(F.lit("PC"), _s(u)).alias("perseus_client_id"), variant.alias("variant"),
                 test_of("c_nationkey").alias("experiment_id"), F.lit(False).alias("is_parallel"),
                 status.alias("customer_status"), F.lit("loc").alias("location"), variant.alias("variant_concat"),
                 F.lit("loc").alias("location_concat"), status.alias("customer_status_concat")).alias("sessions"),
        "events",
        F.when(u % 3 == 0, F.array().cast("array<struct<city_id:bigint,city_name:string,id:bigint,name:string,"
                                          "timezone:string>>"))
        .when(u % 3 == 1, F.array(dzone(1))).otherwise(F.array(dzone(1), dzone(2))).alias("dps_zone"),
        F.struct(((u % 10) * 1.5).cast("double").alias("lon"), ((u % 7) * 0.25).cast("double").alias("lat"))
        .alias("ga_location"))


class World:
    """All nine experiment sources derived from one set of driver tables."""

    def __init__(self, t: Tables):
        self.t = t
        self.entities = entities(t)
        self.experiment_setups = experiment_setups(t)
        self.vendors = vendors(t)
        self.session_orders = session_orders(t)
        self.ab_test_orders = ab_test_orders(t)
        self.shared_orders = shared_orders(t)
        self.fee_override_orders = fee_override_orders(t)
        self.countries = countries(t)
        self.ga_sessions = ga_sessions(t)
