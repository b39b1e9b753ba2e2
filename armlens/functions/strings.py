"""Ordered string aggregates (AGG-1, AGG-2, AGG-3).

``collect_list``/``collect_set`` are partial aggregates: each task combines its
rows before the shuffle, so a hot group never ships raw rows to one task. The
groups these are used on hold a handful of labels (verticals of a test, the
five event actions of a session, the scheme combinations of a test)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_string_agg(c, sep: str = ", ") -> Column:
    """NULLs are skipped; a group of only NULLs gives '' (not NULL, which is
    what ``listagg`` would return)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.array_sort(F.collect_list(c)), sep)


def distinct_sorted_string_agg(c, sep: str = ", ") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.array_sort(F.collect_set(c)), sep)
