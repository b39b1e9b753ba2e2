"""Vertical label normalisation (DOM-4, DOM-15): label tables as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from armlens.functions.compat import capture_or_null

# Fixed values that must equal the experiment setup vocabulary.
RESTAURANT_LABELS = ("restaurant", "restaurants")
SHOP_LABEL = "shop"
DARKSTORES_LABEL = "darkstores"
# Greedy split of a "a, b" list: everything before / after the last ", ".
FIRST_OF_LIST = r"(.*),\s"
SECOND_OF_LIST = r",\s(.*)"
# Vendor label -> test label by region; other labels stay as they are.
FOOD_AND_SHOPS = {"food": "restaurant", "local store": "shop", "dmarts": "shop"}
FOOD_SHOPS_AND_DARKSTORES = {"food": "restaurant", "local store": "shop", "dmarts": "darkstores"}
REGION_LABELS = {"Americas": FOOD_AND_SHOPS, "Asia": FOOD_AND_SHOPS, "MENA": FOOD_SHOPS_AND_DARKSTORES, "Europe": {}}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _canonical(label: Column) -> Column:
    """restaurant(s) -> restaurant, shop -> shop, darkstores -> darkstores, else NULL."""
    return (
        F.when(label.isin(*RESTAURANT_LABELS), F.lit("restaurant"))
        .when(label == SHOP_LABEL, F.lit("shop"))
        .when(label == DARKSTORES_LABEL, F.lit("darkstores"))
    )


def normalize_vertical(v) -> Column:
    """Single raw parent vertical of an order -> canonical label or NULL."""
    return _canonical(F.lower(_c(v)))


def first_parent_vertical(concat_list) -> Column:
    """DOM-4 first label of a ', '-joined, sorted vertical list.

    '' -> NULL; a list with a comma -> canonical form of the greedy prefix
    (three labels give 'a, b', which is not a label -> NULL); a single label ->
    canonical form; an unknown single label -> NULL."""
    s = _c(concat_list)
    return (
        F.when(s == "", F.lit(None).cast("string"))
        .when(s.like("%,%"), _canonical(capture_or_null(F.lower(s), FIRST_OF_LIST)))
        .otherwise(_canonical(F.lower(s)))
    )


def second_parent_vertical(concat_list) -> Column:
    """DOM-4 second label: only lists with a comma have one."""
    s = _c(concat_list)
    return (
        F.when(s == "", F.lit(None).cast("string"))
        .when(s.like("%,%"), _canonical(capture_or_null(F.lower(s), SECOND_OF_LIST)))
    )


def region_vertical(region, raw_vertical) -> Column:
    """DOM-15: map a vendor's raw parent vertical onto the test vocabulary by the
    region's label table; a label outside the table stays, an unknown or NULL
    region gives NULL."""
    r, v = _c(region), F.lower(_c(raw_vertical))
    tables = F.create_map(*[x for name, table in REGION_LABELS.items() for x in (F.lit(name), _literal_map(table))])
    return F.when(r.isin(*REGION_LABELS), F.coalesce(F.try_element_at(F.try_element_at(tables, r), v), v))


def _literal_map(table: dict) -> Column:
    if not table:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
