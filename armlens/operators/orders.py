"""Order fact enrichment (DOM-8 .. DOM-13).

Join strategy (fact = experiment orders, the only large input besides the
three order-keyed lookup tables):

* everything decidable from the fact's own columns runs before any shuffle:
  the membership filters (FLT-8), the allowed-vertical filter (FLT-9, fused
  path), the active-entity join and zone membership, all broadcast behind a
  row bound;
* the shared-orders location, the fee override and (fused path) the VAT
  lookup are all keyed by (entity_id, platform_order_code): they share one
  hash partitioning of the fact, so the fact is shuffled once for all of them
  (the override's date equality is a join condition, not a key);
* containment is then an equality join on the cells of the zone index
  (operators.zones), so the second shuffle (ab-test target group, keyed by
  order_id) sees only orders inside their test zones; the polygon itself is
  attached last;
* target groups (with the time/customer conditions as join residuals), test
  dates and the scheme matches of every (test, label, variant), found once, are
  broadcast experiment dimensions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.config import ExperimentConfig
from armlens.functions.compat import calendar_day_diff, if_else, match_or_null, safe_divide, weekday_name
from armlens.functions.geo import point
from armlens.functions.verticals import normalize_vertical
from armlens.operators.skew import lookup_join
from armlens.operators.zones import ZoneIndex
from armlens.plans.materialize import cut_lineage
from armlens.plans.sizing import DEFAULT_MAX_BYTES, Size, bounded_broadcast, known_size, with_size

NON_TG = "Non_TG"


def _not_null(*cols):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def key_set(df: DataFrame, mapping: dict) -> DataFrame:
    """Distinct non-NULL composite keys, renamed ``{src: dst}`` (FLT-8 right side)."""
    sel = df.select(*[F.col(s).alias(d) for s, d in mapping.items()])
    return sel.where(_not_null(*mapping.values())).distinct()


def semi_filter(df: DataFrame, keys: DataFrame, max_rows: int, bound: Size | None = None) -> DataFrame:
    """FLT-8: composite-key membership. A NULL key part never matches,
    exactly like ``CONCAT(..) IN (SELECT DISTINCT CONCAT(..) ... IS NOT NULL)``.
    ``bound``: size of the table the keys were taken from; where that proves too
    little, the key set is measured itself, and beyond the bound hot keys are
    split off the shuffle."""
    held = bounded_broadcast(keys, max_rows, bound, measure=True)
    if bound is None or bound.fits(max_rows, DEFAULT_MAX_BYTES) or known_size(held) is None:
        return df.join(held, keys.columns, "left_semi")
    return lookup_join(df, held, keys.columns, "left_semi", max_rows)


def time_condition(order_local_ts, start_at, end_at, active_day) -> F.Column:
    """JN-8a: no time condition => match; else the local order date lies in
    [start, end] and its upper-case weekday equals the active day (a partial
    condition never matches)."""
    d = F.to_date(order_local_ts)
    none = F.to_date(start_at).isNull() & F.to_date(end_at).isNull() & active_day.isNull()
    return F.when(none, F.lit(True)).otherwise(
        d.between(F.to_date(start_at), F.to_date(end_at)) & (F.upper(weekday_name(d)) == active_day))


def customer_condition(total_orders, placed_at, first_order_at, orders_lt, days_lt) -> F.Column:
    """JN-8b: no customer condition => match; else fewer orders than the limit
    and (days since first order below the limit, or unknown)."""
    none = orders_lt.isNull() & days_lt.isNull()
    days = calendar_day_diff(placed_at, first_order_at)
    return F.when(none, F.lit(True)).otherwise((total_orders < orders_lt) & ((days < days_lt) | days.isNull()))


def scheme_matches(combos: DataFrame, variants: DataFrame, target_groups: DataFrame, mode: str) -> DataFrame:
    """DOM-11: what may follow 'label | variant | ' in a test's combination list, one row per (entity, country,
    test, label, variant) that occurs in it. Labels are the test's group names and every 'TG<number>' of the
    list; the scheme ids that follow are matched by ``scheme_flag``.

    mode="substring" reproduces ``list LIKE '%' || combo || '%'``: any place of the text counts, up to the 20
    characters a scheme id can have; for a label or variant with a wildcard ('%', '_') the whole list stays as
    ``_wild`` for a LIKE, in which a backslash is an ordinary character. mode="exact": the schemes of whole elements of the combination array."""
    test = ["entity_id", "country_code", "test_id"]
    lists = combos.select(*test, "tg_var_scheme_concat", "tg_var_scheme_list")
    named = lists.join(target_groups.select(*test, F.col("tg_name").alias("label")).distinct(), test)
    listed = lists.withColumn("label", F.explode(F.regexp_extract_all("tg_var_scheme_concat", F.lit(r"(TG\d+) \|"), F.lit(1))))
    labels = named.unionByName(listed.select(*named.columns)).distinct()
    rows = labels.join(variants.select(*test, "variant").distinct(), test)
    prefix = F.concat("label", F.lit(" | "), "variant", F.lit(" | "))
    if mode == "exact":
        whole = F.filter("tg_var_scheme_list", lambda e: F.startswith(e, prefix))
        after, wild = F.transform(whole, lambda e: F.substr(e, F.length(prefix) + 1)), F.lit(None).cast("string")
    else:
        quoted = F.replace(prefix, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        pattern = F.concat(F.lit("(?s)(?=\\Q"), quoted, F.lit("\\E(.{0,20}))"))
        after = F.array_distinct(F.regexp_extract_all("tg_var_scheme_concat", pattern, F.lit(1)))
        wild = F.when(prefix.rlike("[%_]"), F.col("tg_var_scheme_concat"))
    out = rows.select(*test, "label", "variant", after.alias("_after"), wild.alias("_wild"))
    return out.where((F.size("_after") > 0) | F.col("_wild").isNotNull())


def scheme_flag(outside: F.Column, tg_label: F.Column, variant: F.Column, scheme_id: F.Column, after: F.Column,
                wild: F.Column, mode: str) -> F.Column:
    """DOM-11: 'Keep' when the order is outside every target group (``outside``) or its scheme id follows its
    label and variant in the test's combinations (``after``, ``wild`` of ``scheme_matches``), else 'Drop'.
    As in the SQL, scheme 12 matches '... | 123' in mode "substring"."""
    scheme = scheme_id.cast("string")
    if mode == "exact":
        hit = F.array_contains(after, scheme)
    else:
        combo = F.concat(F.lit("%"), tg_label, F.lit(" | "), variant, F.lit(" | "), scheme, F.lit("%"))
        hit = F.when(wild.isNotNull(), F.like(wild, combo, F.lit("\x01"))).otherwise(F.exists(after, lambda a: F.startswith(a, scheme)))
    return if_else(outside | hit, F.lit("Keep"), F.lit("Drop"))


def fee_incl_discounts(covered_by_discount, covered_by_voucher, fee) -> F.Column:
    """DOM-10 part: fee is 0 when a discount or voucher covered it."""
    return if_else((covered_by_discount == True) | (covered_by_voucher == True), F.lit(0), fee)  # noqa: E712


def actual_fee(region, override_fee, fee_incl, override_regions) -> F.Column:
    """DOM-10: override-table fee (fallback: own fee) in override regions, own
    fee elsewhere, NULL for a NULL region."""
    return (F.when(region.isin(*override_regions), F.coalesce(override_fee, fee_incl))
            .when(~region.isin(*override_regions), fee_incl))


def enrich_orders(session_orders: DataFrame, ab_test_orders: DataFrame, shared_orders: DataFrame,
                  fee_overrides: DataFrame, zone_shapes: DataFrame, target_groups: DataFrame,
                  zones: DataFrame, variants: DataFrame, scheme_combos: DataFrame, entities: DataFrame,
                  cfg: ExperimentConfig = ExperimentConfig(), with_profit: bool = False) -> DataFrame:
    """DOM-8: the experiment order table (68 columns).

    ``with_profit=True`` also applies DOM-12/13 (same rows as ``add_profit`` on
    the result): the allowed-vertical filter runs first (a broadcast semi
    join that shrinks the fact early) and the VAT lookup, keyed like the
    location and fee joins, rides on the same shuffle of the fact."""
    bmax = cfg.broadcast_max_rows
    a = session_orders.where((F.col("created_date") >= F.lit(cfg.since).cast("date")) & F.col("is_sent"))
    a = semi_filter(a, key_set(variants, {"entity_id": "entity_id", "country_code": "country_code",
                                          "test_id": "experiment_id", "variant": "variant"}), bmax,
                    known_size(variants))
    a = semi_filter(a, key_set(target_groups, {"entity_id": "entity_id", "country_code": "country_code",
                                               "test_id": "experiment_id"}), bmax, known_size(target_groups))
    if with_profit:
        tg_size = known_size(target_groups)
        keys = allowed_vertical_keys(target_groups).withColumnRenamed("test_id", "experiment_id")
        a = a.withColumn("_vvp", normalize_vertical("vendor_vertical_parent"))
        a = a.join(bounded_broadcast(keys.withColumnRenamed("vendor_vertical_parent", "_vvp"), bmax,
                                     None if tg_size is None else tg_size * 2),
                   ["entity_id", "country_code", "experiment_id", "_vvp"], "left_semi").drop("_vvp")

    # Filters that need no lookup from the big tables run before the shuffle:
    # active entities (inner, carries the entity region) and zone membership
    # (the polygon itself is joined after the location is known).
    ent = entities.select("entity_id", F.col("region").alias("_ent_region"))
    a = a.join(bounded_broadcast(ent, bmax, known_size(entities)), "entity_id", "inner")
    zone_keys = key_set(zone_shapes, {"entity_id": "entity_id", "country_code": "country_code",
                                      "zone_id": "zone_id", "test_id": "experiment_id"})
    a = semi_filter(a, zone_keys, bmax, known_size(zone_shapes))

    # Location (T8: the spatial predicate rejects a missing location -> inner join).
    dwh = shared_orders.select(F.col("global_entity_id").alias("entity_id"),
                               F.col("order_id").alias("platform_order_code"),
                               F.col("delivery_location.longitude").alias("_lon"),
                               F.col("delivery_location.latitude").alias("_lat"))
    a = a.join(dwh, ["entity_id", "platform_order_code"], "inner")
    pdo = fee_overrides.where(F.col("created_date_utc") >= F.lit(cfg.since).cast("date")).select(F.col("global_entity_id").alias("_pd_entity"), F.col("code").alias("_pd_code"),
                               F.col("created_date_utc").alias("_pd_date"),
                               F.col("delivery_fee_local").alias("_pd_fee"))
    a = a.join(pdo, (a["entity_id"] == pdo["_pd_entity"]) & (a["platform_order_code"] == pdo["_pd_code"])
               & (F.datediff(a["created_date"], pdo["_pd_date"]) == 0), "left").drop("_pd_entity", "_pd_code",
                                                                                   "_pd_date")
    if with_profit:
        vat = ab_test_orders.select("entity_id", "platform_order_code", "vat_ratio")
        a = a.join(vat, ["entity_id", "platform_order_code"], "inner")

    # Containment (T8: inner join): equality on the zone's cells, edges are walked in cut cells only.
    zone_key = ["entity_id", "country_code", "zone_id", "experiment_id"]
    zn = with_size(zone_shapes.withColumnRenamed("test_id", "experiment_id"), known_size(zone_shapes))
    a = ZoneIndex(zn, zone_key, max_rows=bmax).locate(a, "_lon", "_lat")

    b = ab_test_orders.select("entity_id", "order_id", F.col("target_group").alias("target_group_bi"))
    a = a.join(b, ["entity_id", "order_id"], "left")

    tg = target_groups.select(F.col("entity_id").alias("_tg_entity"), F.col("vendor_code").alias("_tg_vendor"),
                              F.col("test_id").alias("_tg_test"), F.col("tg_name").alias("_tg_name"),
                              F.col("parent_vertical_concat"), F.col("start_at").alias("_start_at"),
                              F.col("recurrence_end_at").alias("_end_at"), F.col("active_days").alias("_day"),
                              F.col("orders_number_less_than").alias("_orders_lt"),
                              F.col("days_since_first_order_less_than").alias("_days_lt"))
    tg = bounded_broadcast(tg, bmax, known_size(target_groups))
    cond = ((a["entity_id"] == tg["_tg_entity"]) & (a["vendor_id"] == tg["_tg_vendor"])
            & (a["experiment_id"] == tg["_tg_test"])
            & time_condition(a["order_placed_at_local"], tg["_start_at"], tg["_end_at"], tg["_day"])
            & customer_condition(a["customer_total_orders"], a["order_placed_at"], a["customer_first_order_date"],
                                 tg["_orders_lt"], tg["_days_lt"]))
    a = a.join(tg, cond, "left")

    dat = zones.select("entity_id", "country_code", F.col("test_id").alias("experiment_id"),
                       "test_start_date", "test_end_date", "test_name").distinct()
    a = a.join(bounded_broadcast(dat, bmax, known_size(zones)), ["entity_id", "country_code", "experiment_id"], "left")
    shapes = zn.select(*zone_key, F.xxhash64("zone_shape").alias("shape_no"), "zone_shape").distinct()
    a = a.join(bounded_broadcast(shapes, bmax, known_size(zone_shapes)), [*zone_key, "shape_no"], "inner")
    c = F.col
    tg_label = F.coalesce(c("_tg_name"), F.lit(NON_TG))
    bi_label = F.coalesce(F.concat(F.lit("TG"), match_or_null(c("target_group_bi"), r"\d+")), F.lit(NON_TG))
    matches = cut_lineage(scheme_matches(scheme_combos, variants, target_groups, cfg.scheme_match), "scheme_matches")
    held = bounded_broadcast(matches.withColumnRenamed("test_id", "experiment_id"), bmax, known_size(matches))
    for label, suffix in ((tg_label, "tg"), (bi_label, "bi")):
        m = held.select("entity_id", "country_code", "experiment_id", "variant", F.col("label").alias("_label"),
                        F.col("_after").alias(f"_after_{suffix}"), F.col("_wild").alias(f"_wild_{suffix}"))
        a = a.withColumn("_label", label).join(
            m, ["entity_id", "country_code", "experiment_id", "variant", "_label"], "left").drop("_label")
    fee_incl = fee_incl_discounts(c("is_delivery_fee_covered_by_discount"), c("is_delivery_fee_covered_by_voucher"),
                                  c("delivery_fee_local"))
    out = a.select(
        c("created_date").alias("created_date_utc"),
        c("order_placed_at").alias("order_placed_at_utc"),
        "order_placed_at_local",
        weekday_name("order_placed_at_local").alias("dow_local"),
        c("dps_sessionid_created_at").alias("dps_sessionid_created_at_utc"),
        (F.datediff(F.to_date("order_placed_at_local"), F.date_add(F.to_date("test_start_date"), 1)) + 1)
        .alias("day_num_in_test"),
        "region", "entity_id", "country_code", "city_name", "city_id", "zone_name", "zone_id", "zone_shape",
        point(c("_lon"), c("_lat")).alias("customer_location"),
        "variant", c("experiment_id").alias("test_id"), "test_name", "test_start_date", "test_end_date",
        "perseus_client_id", "ga_session_id", "dps_sessionid", "dps_customer_tag", "customer_total_orders",
        "customer_first_order_date",
        calendar_day_diff("order_placed_at", "customer_first_order_date").alias("days_since_first_order"),
        "order_id", "platform_order_code", "scheme_id", "vendor_price_scheme_type", "vendor_id",
        tg_label.alias("target_group"), "target_group_bi", "is_in_treatment", "chain_id", "chain_name",
        "vertical_type", normalize_vertical("vendor_vertical_parent").alias("vendor_vertical_parent"),
        "delivery_status", "is_own_delivery", "exchange_rate",
        "dps_delivery_fee_local", "delivery_fee_local",
        fee_incl.alias("delivery_fee_local_incl_disc_and_vouchers"),
        "dps_travel_time_fee_local", "commission_local", "joker_vendor_fee_local",
        F.coalesce(c("service_fee_local"), F.lit(0)).alias("service_fee_local"),
        c("mov_customer_fee_local").alias("sof_local"),
        "delivery_costs_local",
        actual_fee(c("_ent_region"), c("_pd_fee"), fee_incl, cfg.fee_override_regions)
        .alias("actual_df_paid_by_customer"),
        "gfv_local", "gmv_local",
        "mean_delay", "dps_mean_delay", "dps_mean_delay_zone_id", "travel_time", "dps_travel_time",
        "travel_time_distance_km", "delivery_distance_m", "to_customer_time", "actual_DT",
        "is_delivery_fee_covered_by_discount", "is_delivery_fee_covered_by_voucher",
        "parent_vertical_concat",
        scheme_flag(tg_label == NON_TG, tg_label, c("variant"), c("scheme_id"), c("_after_tg"), c("_wild_tg"),
                    cfg.scheme_match).alias("keep_drop_flag"),
        scheme_flag(F.coalesce(c("target_group_bi"), F.lit(NON_TG)) == NON_TG, bi_label, c("variant"),
                    c("scheme_id"), c("_after_bi"), c("_wild_bi"), cfg.scheme_match).alias("keep_drop_flag_bi"),
        *([c("vat_ratio")] if with_profit else []),
    )
    if with_profit:
        out = revenue_columns(out).drop("vat_ratio")
    if cfg.keep_only:
        out = out.where(F.col(cfg.keep_only) == "Keep")
    return out


def multiplication(rows: DataFrame, by, id_col: str = "order_id") -> DataFrame:
    """T10: per ``by``, the rows, the distinct orders and the rows beyond one an order. Joins with several
    conditions, zones or names multiply rows on purpose; their sums count an order more than once."""
    per_order = rows.where(F.col(id_col).isNotNull()).groupBy(*by, id_col).agg(F.count(F.lit(1)).alias("_n"))
    return per_order.groupBy(*by).agg(
        F.sum("_n").alias("order_rows"), F.count(F.lit(1)).alias("orders"), (F.sum("_n") - F.count(F.lit(1))).alias("extra_rows"),
        F.max("_n").alias("most_rows"))


def revenue_columns(df: DataFrame, vat_col: str = "vat_ratio") -> DataFrame:
    """DOM-12: revenue and gross profit net of VAT (SAFE_DIVIDE -> NULL on a
    zero divisor; un-coalesced NULL parts make the sum NULL, T9)."""
    c = F.col
    den = F.lit(1) + c(vat_col)
    fee_part = if_else(c("is_own_delivery") == True, safe_divide(c("actual_df_paid_by_customer"), den),  # noqa: E712
                       F.lit(0))
    revenue = (fee_part + c("commission_local") + c("joker_vendor_fee_local")
               + safe_divide(c("service_fee_local"), den) + safe_divide(c("sof_local"), den))
    return df.withColumns({"revenue_local": revenue,
                           "gross_profit_local": revenue - c("delivery_costs_local")})


def allowed_vertical_keys(target_groups: DataFrame) -> DataFrame:
    """FLT-9: first OR second allowed vertical, stacked into one key set."""
    base = ["entity_id", "country_code", "test_id"]
    first = target_groups.select(*base, F.col("first_parent_vertical").alias("vendor_vertical_parent"))
    second = target_groups.select(*base, F.col("second_parent_vertical").alias("vendor_vertical_parent"))
    keys = first.unionByName(second)
    return keys.where(_not_null(*base, "vendor_vertical_parent")).distinct()


def add_profit(enriched: DataFrame, ab_test_orders: DataFrame, target_groups: DataFrame,
               cfg: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    """DOM-12 + DOM-13: VAT join on the platform order code (inner), revenue and
    gross profit, and the allowed-vertical filter (a test with no vertical keeps
    no order, T11)."""
    b = ab_test_orders.select("entity_id", "platform_order_code", "vat_ratio")
    tg_size = known_size(target_groups)
    keys = bounded_broadcast(allowed_vertical_keys(target_groups), cfg.broadcast_max_rows,
                             None if tg_size is None else tg_size * 2)
    x = enriched.join(keys, ["entity_id", "country_code", "test_id", "vendor_vertical_parent"], "left_semi")
    x = x.join(b, ["entity_id", "platform_order_code"], "inner")
    out = revenue_columns(x)
    return out.select(*enriched.columns, "revenue_local", "gross_profit_local")
