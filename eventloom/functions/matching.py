"""When two records are the same event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def alike(a: Column, b: Column) -> Column:
    """Two normalised names, neither empty, that are equal, contain one another, or share two words."""
    full = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    shared = F.size(F.array_intersect(F.split(a, " "), F.split(b, " "))) >= 2
    return F.coalesce(full & (F.contains(a, b) | F.contains(b, a) | shared), F.lit(False))


def states_match(a: Column, b: Column) -> Column:
    """Whether no two states differ; a missing or empty one fits any."""
    up = lambda s: F.upper(F.coalesce(s, F.lit("")))
    return ~((up(a) != "") & (up(b) != "") & (up(a) != up(b)))


def tracks_match(name_a: Column, state_a: Column, name_b: Column, state_b: Column) -> Column:
    """Whether normalised track names are alike and no two states differ."""
    return states_match(state_a, state_b) & alike(name_a, name_b)


def ranges_overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Whether each range starts by the other's end; a missing end is the start; a missing start overlaps nothing.

    For a range that ends before it starts this holds where the other one covers both its days.
    """
    return F.coalesce((start_a <= F.coalesce(end_b, start_b)) & (start_b <= F.coalesce(end_a, start_a)), F.lit(False))
