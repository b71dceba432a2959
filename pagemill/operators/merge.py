"""Several payload rows of one record merged into one document, without gathering their rows.

A payload is taken apart into single keys and single list items. What of a key counts is the last payload that has it, an
arg-max that is aggregated partially on every map task; list items only ever meet in the document they are part of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _entries(rows: DataFrame, value: str) -> DataFrame:
    """One row per key of an object or item of a list in the VARIANT column ``value``; others give none."""
    found = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(value).outer()))
    return found.withColumnRenamed("pos", f"{value}_pos").withColumnRenamed("key", f"{value}_key").withColumnRenamed("value", f"{value}_value")


def _is(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).startswith(kind)


def merged_payloads(rows: DataFrame, key: list[str], order: str, payload: str = "payload") -> DataFrame:
    """(key, payload): one JSON document per record of the JSON texts in ``payload``, in the order of ``order``.

    Objects in ``included`` lists and in ``data.elements`` lists are strung together; of every other key of the document and
    of its ``data`` the last value counts, in the place where the key stood first. Payloads that are no object count for
    nothing; a record whose payloads are all such gives ``{}``. Ties of ``order`` are decided by the text. ``order`` may
    be of any sortable type; null orders come first.
    """
    names = [f"_k{i}" for i in range(len(key))]
    by = [F.col(k).alias(n) for k, n in zip(key, names)]
    given = rows.select(*by, F.struct(F.col(order).alias("order"), F.col(payload).alias("text")).alias("at"), F.try_parse_json(payload).alias("doc"))
    given = given.select(*names, "at", F.when(_is(F.col("doc"), "OBJECT"), F.col("doc")).alias("doc"))
    top = _entries(given, "doc").where("doc_key is not null").select(*names, "at", "doc_pos", F.col("doc_key").alias("name"), F.col("doc_value").alias("body"))
    lists = top.where(F.col("name").isin("included", "data")).withColumn("list", F.when(
        F.col("name") == "data", F.when(_is(F.col("body"), "OBJECT"), F.try_variant_get("body", "$.elements", "variant"))
    ).otherwise(F.col("body"))).where(_is(F.col("list"), "ARRAY"))
    items = _entries(lists, "list").where(_is(F.col("list_value"), "OBJECT")).select(
        *names, F.when(F.col("name") == "data", "elements").otherwise("included").alias("part"), F.lit(None).cast("string").alias("name"),
        F.struct("at", F.col("list_pos").alias("pos")).alias("first"), F.to_json("list_value").alias("body"),
    )
    inner = _entries(top.where((F.col("name") == "data") & _is(F.col("body"), "OBJECT")), "body").where("body_key <> 'elements'").select(
        *names, F.lit("data").alias("part"), F.col("body_key").alias("name"), "at", F.col("body_pos").alias("pos"), F.col("body_value").alias("body")
    )
    outer = top.where(~F.col("name").isin("included", "data")).select(*names, F.lit("top").alias("part"), "name", "at", F.col("doc_pos").alias("pos"), "body")
    last = outer.unionByName(inner).groupBy(*names, "part", "name").agg(
        F.min(F.struct("at", "pos")).alias("first"), F.to_json(F.max_by("body", "at")).alias("body")
    )
    every = given.select(*names, F.lit("none").alias("part"), F.lit(None).cast("string").alias("name"), F.lit(None).cast(last.schema["first"].dataType).alias("first"), F.lit(None).cast("string").alias("body")).distinct()
    parts = last.unionByName(items).unionByName(every)

    def collected(part: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct("first", "name", "body"))))

    whole = parts.groupBy(*names).agg(*[collected(p).alias(p) for p in ("top", "data", "included", "elements")])
    # A key is written as JSON by way of a one-item list, whose brackets are cut off.
    pair = lambda p: F.concat(F.regexp_replace(F.to_json(F.array(p["name"])), r"^\[|\]$", ""), F.lit(":"), p["body"])
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.transform(c, lambda p: p["body"]), ","), F.lit("]"))
    own = F.concat(F.transform("data", pair), F.when(F.size("elements") > 0, F.array(F.concat(F.lit('"elements":'), listed("elements")))).otherwise(F.array().cast("array<string>")))
    fields = F.concat(
        F.transform("top", pair),
        F.when(F.size(own) > 0, F.array(F.concat(F.lit('"data":{'), F.array_join(own, ","), F.lit("}")))).otherwise(F.array().cast("array<string>")),
        F.when(F.size("included") > 0, F.array(F.concat(F.lit('"included":'), listed("included")))).otherwise(F.array().cast("array<string>")),
    )
    return whole.select(*[F.col(n).alias(k) for k, n in zip(key, names)], F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}")).alias(payload))
