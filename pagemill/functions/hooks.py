"""What a platform's record is normalised to: one rule for each platform, as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.arrays import let
from pagemill.functions.values import first_text, last_wins, overlay

_VARIANTS = "map<string,variant>"


def _texts(**values: Column) -> Column:
    """A map of those values that aren't null or blank."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])
    held = F.filter(entries, lambda e: e["value"].isNotNull() & (e["value"] != ""))
    return F.map_from_entries(F.transform(held, lambda e: F.struct(e["key"].alias("key"), e["value"].cast("variant").alias("value"))))


def _filled(structured: Column) -> Column:
    """An object's filled values; anything else has none."""
    entries = F.coalesce(F.map_entries(F.from_json(structured, _VARIANTS)), F.array().cast("array<struct<key:string,value:variant>>"))
    return F.map_filter(last_wins(entries), lambda _, v: F.coalesce(~F.to_json(v).isin("null", '""', "[]", "{}"), F.lit(False)))


def _first_line(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\R", 2)[0]


def normalised(platform: Column, record: Column, fields: Column, metadata: Column, plain_text: Column, structured: Column) -> Column:
    """The normalised fields of a record as JSON text, by the rule of its platform; unknown platforms follow the generic one.

    ``record`` (the input), ``fields`` (what its address was built from) and ``metadata`` are string maps, ``structured`` is
    JSON text. Blank and null values are left out, but an article's summary and a paper's abstract, which may be empty.
    """
    at = lambda held, name: F.try_element_at(held, F.lit(name))
    title, own = at(metadata, "title"), _filled(structured)
    always = lambda name, value: F.create_map(F.lit(name), value.cast("variant"))
    in_structured = lambda name: F.try_variant_get(F.try_parse_json(structured), f"$.{name}", "string")

    article = overlay(_texts(title=first_text(title, at(record, "title")), page_id=at(metadata, "page_id")), always("summary", _first_line(plain_text)))
    abstract = F.coalesce(first_text(at(metadata, "description"), in_structured("abstract_plain_text"), _first_line(plain_text)), F.lit(""))
    paper = overlay(_texts(arxiv_id=at(fields, "arxiv_id")), always("abstract", abstract))
    given = F.transform_values(F.map_filter(fields, lambda _, v: v.isNotNull() & (v != "")), lambda _, v: v.cast("variant"))
    product = overlay(overlay(given, _texts(title=first_text(title, in_structured("title")))), F.map_filter(own, lambda k, _: k != "title"))
    chain = _texts(identifier=F.try_element_at(F.map_values(fields), F.lit(1)), title=title)
    # What the payload says stands before what the address and the page say.
    entity = overlay(_texts(public_identifier=at(fields, "public_identifier"), title=title), own)
    page = _texts(title=title, description=at(metadata, "description"), source_url=at(metadata, "source_url"))
    rules = {"wikipedia": article, "arxiv": paper, "amazon": product, "base": chain, "linkedin": entity}
    out = page
    for name, rule in rules.items():
        out = F.when(platform == name, rule).otherwise(out)
    return let(out, lambda m: F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))))
