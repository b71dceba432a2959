"""Array helpers that stay linear or n log n per row: packing ranges and first occurrences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGES = "array<struct<first:int,stop:int>>"


def _int(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that captures an outer expression computes it again for every element; binding
    it to a lambda variable first avoids that.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def first_occurrences(items: Column, key: Callable[[Column, Column], Column]) -> Column:
    """Items whose key appears for the first time, in their order.

    Sorting by key and comparing neighbours keeps this n log n for very long rows.
    """
    tagged = F.transform(items, lambda x, i: F.struct(key(x, i).alias("k"), i.alias("i"), x.alias("v")))
    return let(F.sort_array(tagged), _first_of_runs)


def _first_of_runs(ordered: Column) -> Column:
    before = F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("k"))),
        F.transform(F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))), lambda x: F.struct(x["k"].alias("k"))),
    )
    pairs = F.arrays_zip(ordered.alias("own"), F.slice(before, 1, F.size(ordered)).alias("before"))
    firsts = F.filter(pairs, lambda p: ~p["own"]["k"].eqNullSafe(p["before"]["k"]))
    back = F.sort_array(F.transform(firsts, lambda p: F.struct(p["own"]["i"].alias("i"), p["own"]["v"].alias("v"))))
    return F.transform(back, lambda p: p["v"])


def pack_ranges(weights: Column, limit: int, carry: int = 0) -> Column:
    """Greedy packing of consecutive items: ``array<struct<first, stop>>``, stop exclusive.

    A range closes when the next item would take it over ``limit``. The next range then starts
    with the longest tail of the closed one whose weight is at most ``carry``. Only range
    bounds are copied when a range closes, never the items.
    """
    return let(weights, lambda w: _pack(w, limit, carry))


def _pack(weights: Column, limit: int, carry: int) -> Column:

    def tail(acc: Column) -> Column:
        own = F.reverse(F.slice(weights, acc["first"] + 1, acc["at"] - acc["first"]))
        start = F.struct(_int(0).alias("n"), _int(0).alias("sum"), F.lit(True).alias("open"))

        def grow(state: Column, weight: Column) -> Column:
            fits = state["open"] & (state["sum"] + weight <= carry)
            return F.struct(
                F.when(fits, state["n"] + 1).otherwise(state["n"]).cast("int").alias("n"),
                F.when(fits, state["sum"] + weight).otherwise(state["sum"]).cast("int").alias("sum"),
                fits.alias("open"),
            )

        return F.aggregate(own, start, grow)

    def step(acc: Column, weight: Column) -> Column:
        full = (acc["sum"] + weight > limit) & (acc["at"] > acc["first"])
        closed = F.concat(acc["done"], F.array(F.struct(acc["first"].alias("first"), acc["at"].alias("stop"))))
        if carry > 0:
            first, total = acc["at"] - tail(acc)["n"], tail(acc)["sum"] + weight
        else:
            first, total = acc["at"], weight
        return F.struct(
            _int(acc["at"] + 1).alias("at"),
            F.when(full, first).otherwise(acc["first"]).cast("int").alias("first"),
            F.when(full, total).otherwise(acc["sum"] + weight).cast("int").alias("sum"),
            F.when(full, closed).otherwise(acc["done"]).alias("done"),
        )

    zero = F.struct(
        _int(0).alias("at"), _int(0).alias("first"), _int(0).alias("sum"), F.array().cast(RANGES).alias("done")
    )

    def finish(acc: Column) -> Column:
        last = F.array(F.struct(acc["first"].alias("first"), acc["at"].alias("stop")))
        return F.when(acc["at"] > acc["first"], F.concat(acc["done"], last)).otherwise(acc["done"])

    return F.aggregate(weights, zero, step, finish)


def joined(items: Column, span: Column, separator: str) -> Column:
    """Items of one range as text."""
    return F.array_join(F.slice(items, span["first"] + 1, span["stop"] - span["first"]), separator)
