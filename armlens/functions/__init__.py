"""Column-level building blocks shared by all operators."""

from armlens.functions.compat import (  # noqa: F401
    calendar_day_diff,
    capture_or_null,
    if_else,
    match_or_null,
    safe_divide,
    try_double,
    weekday_name,
)
from armlens.functions.geo import point, point_in_ring, point_wkt  # noqa: F401
from armlens.functions.strings import (  # noqa: F401
    distinct_sorted_string_agg,
    sorted_string_agg,
)
