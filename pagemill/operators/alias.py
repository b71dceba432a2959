"""Record projections: address templates, seeds, aliases, enrichment input, canonical records."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import specs
from pagemill.functions import url as U
from pagemill.functions.batches import bounds, text_pieces
from pagemill.functions.text import doc_id, strip
from pagemill.functions.values import first_text, overlay, pick


def _search_path(value: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in specs.SEARCH_PATHS.items() for x in pair])
    return F.try_element_at(table, F.lower(strip(value)))


def _url_value(field: str, value: Column) -> Column:
    if field == "title":
        return U.percent_encode(F.replace(value, F.lit(" "), F.lit("_")), "_()")
    if field == "query":
        return U.percent_encode(value, "")
    if field == "search_type":
        return _search_path(value)
    return value


def _render(template: str, values: dict[str, Column]) -> Column:
    parts = [p for p in re.split(r"(\{\w+\})", template) if p]
    return F.concat(*[values[p[1:-1]] if p.startswith("{") else F.lit(p) for p in parts])


def seed(record: Column, platform: Column, resource_type: Column) -> Column:
    """Seed of an input record given as a string map.

    A given address is taken as it is; otherwise the template of (platform, type) is filled from
    the first filled alias of each required field. A record that cannot be built carries an error
    instead of failing the run.
    """
    given = first_text(F.try_element_at(record, F.lit("canonical_url")))
    skipped = ("plain_text", "markdown", "structured", "metadata", "artifacts")
    identity = F.map_filter(record, lambda k, v: ~k.isin(*skipped) & v.isNotNull() & (v != ""))
    address = F.lit(None).cast("string")
    fields = F.create_map().cast("map<string,string>")
    artifacts = F.create_map().cast("map<string,string>")
    error = F.concat(F.lit("unknown target "), F.concat_ws("/", platform, resource_type))
    for (name, kind), (template, required) in specs.URL_TEMPLATES.items():
        aliases = specs.FIELD_ALIASES[(name, kind)]
        raw = {f: pick(record, aliases.get(f, (f,))) for f in required}
        values = {f: _url_value(f, raw[f]) for f in required}
        here = (platform == name) & (resource_type == kind)
        missing = F.lit(None).cast("string")
        for field in reversed(required):
            missing = (
                F.when(raw[field].isNull(), F.lit(f"missing field {field}"))
                .when(values[field].isNull(), F.lit(f"unsupported {field}"))
                .otherwise(missing)
            )
        address = F.when(here, _render(template, values)).otherwise(address)
        pairs = [x for f in required for x in (F.lit(f), values[f])]
        fields = F.when(here & missing.isNull(), F.create_map(*pairs)).otherwise(fields)
        extra = specs.ARTIFACT_TEMPLATES.get((name, kind))
        if extra:
            made = F.create_map(*[x for k, t in extra.items() for x in (F.lit(k), _render(t, values))])
            artifacts = F.when(here & missing.isNull(), made).otherwise(artifacts)
        error = F.when(here, missing).otherwise(error)
    direct = given.isNotNull()
    return F.struct(
        F.when(direct, given).otherwise(address).alias("canonical_url"),
        F.when(direct, F.lit("canonicalized_input")).otherwise(F.lit("template_construction")).alias("discovery_mode"),
        F.when(direct, identity).otherwise(fields).alias("identity"),
        artifacts.alias("artifacts"),
        F.when(~direct, error).alias("error"),
    )


def candidates(records: DataFrame, record: str = "record") -> DataFrame:
    """Seed candidates of input records: score 1, no hop, own address as seed."""
    own = F.col(record)
    platform = F.coalesce(first_text(F.try_element_at(own, F.lit("platform"))), F.lit("generic"))
    kind = F.coalesce(first_text(F.try_element_at(own, F.lit("resource_type"))), F.lit("page"))
    return (
        records.withColumns({"platform": platform, "resource_type": kind})
        .withColumn("_seed", seed(own, F.col("platform"), F.col("resource_type")))
        .select(
            *records.columns, "platform", "resource_type", "_seed.*",
            F.col("_seed.canonical_url").alias("seed_url"), F.lit(1.0).alias("score"), F.lit(0).alias("hop_depth"),
        )
    )


#: Record keys that never become enrichment fields.
NOT_FIELDS = (
    "artifacts", "chunks", "discovery", "document_blocks", "enrichment", "errors",
    "extraction_quality", "metadata", "source",
)


def _flat(text: str | None) -> dict[str, str]:
    try:
        top = json.loads(text) if text else None
    except ValueError:
        top = None
    out: dict[str, str] = {}
    open_objects = [iter(top.items())] if isinstance(top, dict) else []
    while open_objects:
        key, held = next(open_objects[-1], (None, None))
        if key is None:
            open_objects.pop()
            continue
        if key not in out and held not in (None, "", [], {}):
            out[key] = held if isinstance(held, str) else json.dumps(held, ensure_ascii=False, separators=(",", ":"))
        if isinstance(held, dict):
            open_objects.append(iter(held.items()))
    return out


@F.arrow_udf(T.MapType(T.StringType(), T.StringType()))
def flatten_json(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """JSON object text as a string map of every key at every level; the first filled one in document order wins."""
    for texts in batches:
        for first, n in text_pieces(texts):
            flat = [_flat(t) for t in texts.slice(first, n).to_pylist()]
            keys, held = [k for f in flat for k in f], [v for f in flat for v in f.values()]
            yield pa.MapArray.from_arrays(bounds([len(f) for f in flat]), pa.array(keys, pa.string()), pa.array(held, pa.string()))


#: Keys that only the record itself fills.
OWN_KEYS = ("doc_id", "canonical_url", "platform", "resource_type", "plain_text", "markdown", "structured", "title", "description")


def enrichment_input(record: Column, structured: Column, metadata: Column) -> Column:
    """Fields for enrichment as a string map.

    Precedence: fixed keys, record keys, flattened structured fields, metadata; then the common
    and the platform alias rules in order, each seeing what the ones before it have filled.
    """

    def get(name: str) -> Column:
        return first_text(F.try_element_at(record, F.lit(name)))

    platform = F.coalesce(get("platform"), F.lit("unknown"))
    kind = F.coalesce(get("resource_type"), get("entity_type"), F.lit("unknown"))
    fixed = F.create_map(
        F.lit("doc_id"), F.coalesce(get("doc_id"), doc_id(get("canonical_url"), platform)),
        F.lit("canonical_url"), get("canonical_url"),
        F.lit("platform"), platform,
        F.lit("resource_type"), kind,
        F.lit("title"), first_text(F.try_element_at(metadata, F.lit("title")), get("title")),
        F.lit("description"), first_text(F.try_element_at(metadata, F.lit("description")), get("description")),
    )

    def filled(mapping: Column) -> Column:
        return F.map_filter(mapping, lambda k, v: v.isNotNull() & (v != "") & ~k.isin(*NOT_FIELDS))

    def others(mapping: Column) -> Column:
        return F.map_filter(filled(mapping), lambda k, _: ~k.isin(*OWN_KEYS))

    return overlay(overlay(overlay(others(metadata), others(structured)), filled(record)), filled(fixed))


RULE = "struct<platform:string,resource_type:string,target:string,names:array<string>>"


def _alias_rules() -> Column:
    """Common rules, then platform rules, as one constant array."""
    rules = [
        {"platform": None, "resource_type": None, "target": target, "names": list(names)}
        for target, names in specs.COMMON_ALIASES
    ]
    for (platform, kind), own in specs.PLATFORM_ALIASES.items():
        rules += [
            {"platform": platform, "resource_type": kind, "target": target, "names": list(names)} for target, names in own
        ]
    return F.from_json(F.lit(json.dumps(rules)), f"array<{RULE}>")


def apply_aliases(fields: Column) -> Column:
    """Fill fields from their aliases: common rules, then those of the row's (platform, type).

    One fold over the rules, because a later rule sees what an earlier one has filled.
    """

    def step(held: Column, rule: Column) -> Column:
        mine = rule["platform"].isNull() | (
            (rule["platform"] == F.try_element_at(held, F.lit("platform")))
            & (rule["resource_type"] == F.try_element_at(held, F.lit("resource_type")))
        )
        empty = F.coalesce(F.try_element_at(held, rule["target"]), F.lit("")) == ""
        values = F.filter(F.transform(rule["names"], lambda n: F.try_element_at(held, n)), lambda v: v != "")
        wanted = F.coalesce(mine & empty & (F.size(values) > 0), F.lit(False))
        rest = F.map_filter(held, lambda k, _: k != rule["target"])
        return F.when(wanted, F.map_concat(rest, F.create_map(rule["target"], F.element_at(values, 1)))).otherwise(held)

    return F.aggregate(_alias_rules(), fields, step)


def canonical_record(platform: Column, entity_type: Column, url: Column) -> Column:
    """Record with every default column of the output contract."""
    empty = F.create_map().cast("map<string,string>")
    none = F.array().cast("array<string>")
    return F.struct(
        platform.alias("platform"), entity_type.alias("entity_type"), entity_type.alias("resource_type"),
        url.alias("canonical_url"), F.lit("success").alias("status"), F.lit("normalized").alias("stage"),
        F.lit(False).alias("retryable"), F.lit(None).cast("string").alias("error_code"),
        F.lit("none").alias("next_action"), empty.alias("metadata"), F.lit("").alias("plain_text"),
        F.lit("").alias("markdown"), none.alias("document_blocks"), empty.alias("structured"),
        none.alias("artifacts"), empty.alias("source"),
    )


def fetched_page(row: DataFrame) -> DataFrame:
    """Older fetch rows in the present shape: text stands in for HTML, status defaults to 200."""
    return row.withColumns(
        {
            "html": first_text(F.col("html"), F.col("text")),
            "status_code": F.coalesce(F.col("status_code"), F.lit(200)),
            "final_url": first_text(F.col("final_url"), F.col("url")),
        }
    )
