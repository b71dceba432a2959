"""Emptiness, alias and map helpers shared by every projection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.arrays import first_occurrences, let


def blank_to_null(value: Column) -> Column:
    """NULL for the empty string, otherwise the value."""
    return F.nullif(value, F.lit(""))


def first_text(*values: Column) -> Column:
    """First non-empty string, from left to right."""
    return F.coalesce(*[blank_to_null(v) for v in values])


def first_filled(*values: Column) -> Column:
    """First non-empty array or map, from left to right."""
    return F.coalesce(*[F.when(F.size(v) > 0, v) for v in values])


def filled_entries(mapping: Column) -> Column:
    """Map without its null and empty-string values."""
    return F.map_filter(mapping, lambda _, v: v.isNotNull() & (v != ""))


def overlay(base: Column, override: Column) -> Column:
    """Union of two string maps; on a shared key ``override`` wins."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(override, k))
    return F.map_concat(kept, override)


def last_wins(entries: Column) -> Column:
    """Map of entries (key, value) whatever the session's rule for repeated keys; the last entry of a key counts."""

    def kept(latest: Column) -> Column:
        places = F.transform(latest, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i")))
        return F.transform(first_occurrences(places, lambda p, _: p["key"]), lambda p: F.get(latest, p["i"]))

    return F.map_from_entries(F.reverse(let(F.reverse(entries), kept)))


def pick(mapping: Column, names: Iterable[str]) -> Column:
    """First non-empty value of a string map under the given key names."""
    return first_text(*[F.try_element_at(mapping, F.lit(n)) for n in names])


def ordered_distinct(values: Column) -> Column:
    """Distinct elements in order of first appearance."""
    return F.array_distinct(values)
