"""JSON documents of any shape as flat rows: one Arrow step walks a document, everything after it is an expression."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.arrays import let
from pagemill.functions.batches import bounds, text_pieces

#: ``path`` has the keys and list indexes that lead to a value, ``place`` the positions among siblings: places in ascending
#: order are the document's order, with each object before what it holds.
_ROW = T.ArrayType(T.StructType([
    T.StructField("path", T.ArrayType(T.StringType())), T.StructField("place", T.ArrayType(T.IntegerType())),
    T.StructField("kind", T.StringType()), T.StructField("value", T.StringType()),
]))


def _walk(text: str, scalars: bool, lists: frozenset[str]) -> Iterator[tuple[list[str], list[int], str, str]]:
    try:
        todo = [([], [], json.loads(text))]
    except ValueError:
        return
    while todo:
        path, place, node = todo.pop()
        if isinstance(node, dict):
            if len(path) > 1 and path[-2] in lists:
                yield path, place, "object", json.dumps(node, ensure_ascii=False)
            inside = [([*path, k], [*place, i], v) for i, (k, v) in enumerate(node.items())]
        elif isinstance(node, list):
            inside = [([*path, str(i)], [*place, i], v) for i, v in enumerate(node)]
        else:
            if scalars:
                kind = "null" if node is None else "boolean" if isinstance(node, bool) else "string" if isinstance(node, str) else "number"
                yield path, place, kind, node if kind == "string" else str(node)
            continue
        todo += reversed(inside)


def _rows(scalars: bool, lists: frozenset[str]):
    names = ("path", "place", "kind", "value")
    kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.string(), pa.string())

    @F.arrow_udf(_ROW)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for first, n in text_pieces(texts):
                found = [list(_walk(t, scalars, lists)) if t else [] for t in texts.slice(first, n).to_pylist()]
                columns = list(zip(*(row for rows in found for row in rows))) or [()] * len(names)
                rows = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))
                yield pa.ListArray.from_arrays(bounds([len(rows) for rows in found]), rows)

    return run


def scalar_rows(document: Column) -> Column:
    """Every string, number, boolean and null of a JSON text; no rows for invalid text."""
    return _rows(True, frozenset())(document)


def listed_objects(document: Column, *lists: str) -> Column:
    """The objects that stand in lists of the given names at any depth, as JSON text: an object's lists in the order of
    the names, then what is deeper."""
    rank = F.array(*[F.lit(n) for n in lists])

    def placed(r: Column) -> Column:
        outer = F.slice(r["place"], 1, F.size(r["place"]) - 2)
        return F.struct(
            outer.alias("outer"), F.array_position(rank, F.element_at(r["path"], -2)).alias("list"),
            F.element_at(r["place"], -1).alias("index"), r["value"].alias("value"),
        )

    return let(_rows(False, frozenset(lists))(document), lambda rows: F.transform(F.array_sort(F.transform(rows, placed)), lambda p: p["value"]))


def first_at(rows: Column, paths: tuple[tuple[str, ...], ...]) -> Column:
    """The first non-blank string or number that some object holds at one of ``paths``: the outermost and earliest object
    that has one decides, and of its paths the first."""

    def hits(r: Column) -> Column:
        usable = r["kind"].isin("string", "number") & (F.trim(r["value"]) != "")
        found = []
        for i, path in enumerate(paths):
            ends = F.slice(r["path"], F.greatest(F.size(r["path"]) - len(path) + 1, F.lit(1)), len(path)) == F.array(*[F.lit(p) for p in path])
            owner = F.slice(r["place"], 1, F.greatest(F.size(r["place"]) - len(path), F.lit(0)))
            found.append(F.when(usable & ends, F.struct(owner.alias("owner"), F.lit(i).alias("path"), F.trim(r["value"]).alias("value"))))
        return F.array_compact(F.array(*found))

    return F.array_min(F.flatten(F.transform(rows, hits)))["value"]


def value_at_pointer(document: Column, pointer: Column) -> Column:
    """The value at a JSON pointer (RFC 6901) that may differ by row, as JSON text; NULL where it leads nowhere.

    Steps are keys of objects and indexes of lists; ``~1`` is a slash and ``~0`` a tilde. A pointer starts with a slash.
    """
    steps = F.transform(F.split(F.substr(pointer, F.lit(2)), "/"), lambda s: F.replace(F.replace(s, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~")))
    index = lambda s: F.when(s.rlike("^[0-9]{1,9}$"), s.cast("int"))

    def down(node: Column, step: Column) -> Column:
        in_object = F.try_element_at(F.from_json(F.when(F.startswith(node, F.lit("{")), node), "map<string,variant>"), step)
        in_list = F.get(F.from_json(F.when(F.startswith(node, F.lit("[")), node), "array<variant>"), index(step))
        return F.to_json(F.coalesce(in_object, in_list))

    return F.when(F.startswith(pointer, F.lit("/")), F.aggregate(steps, F.to_json(F.try_parse_json(document)), down))
