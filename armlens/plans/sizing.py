"""Broadcast only behind a proven size, in rows and in bytes.

A proof comes from one of two places:

* a table materialised by ``plans.materialize`` carries the rows and the summed
  value bytes observed while it was written (no extra job). A frame derived from
  it by projection, filter, distinct or semi join is no larger, and the operators
  pass that size explicitly;
* where the source proves too little, the derived frame itself is measured: it is
  materialised once, counted as it is written, and decided on its own size.

Beyond the bound, or with nothing proven, the frame is returned unhinted:
Catalyst plans a shuffle join, which AQE may still turn into a broadcast once
runtime statistics prove the side small; ``operators.skew.split_join`` is the way
for keys that may be hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 256 * 1024 * 1024  # value bytes; a hashed relation takes a small multiple
SIZE_ATTR = "_armlens_size"


@dataclass(frozen=True)
class Size:
    """Proven upper bounds; ``bytes=None``: only the rows are known."""
    rows: int
    bytes: int | None = None

    def __mul__(self, k: int) -> "Size":
        return Size(self.rows * k, None if self.bytes is None else self.bytes * k)

    def fits(self, max_rows: int, max_bytes: int) -> bool:
        return self.rows <= max_rows and (self.bytes is None or self.bytes <= max_bytes)


def value_bytes(c: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes in a row: 8 for a fixed-width one or its slot, more for what has a length."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(kind, T.ArrayType):
        each = _fixed_bytes(kind.elementType)
        if each is not None:  # no walk over the elements
            return F.lit(24) + each * F.coalesce(F.array_size(c), F.lit(0))
        inner = F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + value_bytes(x, kind.elementType))
        return F.lit(24) + F.coalesce(inner, F.lit(0))
    if isinstance(kind, T.MapType):
        return value_bytes(F.map_keys(c), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(c), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return sum((value_bytes(c.getField(f.name), f.dataType) for f in kind.fields), F.lit(16))
    return F.lit(_fixed_bytes(kind))


def _fixed_bytes(kind: T.DataType) -> int | None:
    """Bytes of a value of a kind whose values all take the same, else None."""
    if isinstance(kind, T.StructType):
        parts = [_fixed_bytes(f.dataType) for f in kind.fields]
        return None if None in parts else 16 + sum(parts)
    if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType)):
        return None
    return 24 if isinstance(kind, T.DecimalType) and kind.precision > 18 else 8


def row_bytes(df: DataFrame) -> Column:
    return sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16)).cast("long")


def known_size(df: DataFrame) -> Size | None:
    """Size recorded when ``df`` was materialised, else None."""
    return getattr(df, SIZE_ATTR, None)


def known_rows(df: DataFrame) -> int | None:
    size = known_size(df)
    return None if size is None else size.rows


def with_size(df: DataFrame, size: Size | None) -> DataFrame:
    """``df`` with a recorded size; ``None`` records nothing."""
    setattr(df, SIZE_ATTR, size)
    return df


def with_rows(df: DataFrame, rows: int | None) -> DataFrame:
    return with_size(df, None if rows is None else Size(int(rows)))


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, bound: int | Size | None = None,
                      max_bytes: int = DEFAULT_MAX_BYTES, measure: bool = False) -> DataFrame:
    """``broadcast(df)`` when at most ``max_rows`` rows and ``max_bytes`` bytes are proven, else ``df``.
    ``bound``: an upper bound known to the caller, e.g. the size of the table ``df`` was derived from.
    ``measure``: if the bound does not prove it, materialise ``df`` and decide on its own size."""
    size = bound if bound is not None else known_size(df)
    if isinstance(size, int):
        size = Size(size)
    if size is not None and size.fits(max_rows, max_bytes):
        return F.broadcast(df)
    if size is not None and measure:
        from armlens.plans.materialize import cut_lineage
        own = cut_lineage(df, "measured")
        return F.broadcast(own) if known_size(own).fits(max_rows, max_bytes) else own
    return df  # nothing is proven: Catalyst and AQE decide
