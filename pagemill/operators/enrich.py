"""Enrichment: pattern sets, dictionaries, field groups, pending answers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import specs
from pagemill.functions.arrays import let
from pagemill.functions.text import strip, unfence
from pagemill.functions.values import first_text, overlay
from pagemill.operators.replay import budget_gate

LOOP = re.compile(
    r"\{%\s*for\s+(\w+)\s*,\s*(\w+)\s+in\s+source_fields\.items\(\)\s*%\}(.*?)\{%\s*endfor\s*%\}", re.S
)
REFERENCE = re.compile(r"\{\{\s*source_fields\.get\([\"'](\w+)[\"']\)\s*\}\}")
#: Fixed value: shortest overlap that counts as a prefix match.
SHORTEST_PREFIX = 4
#: Rows of one looked-up value that are joined in one part.
PART_ROWS = 5_000
SKIP_VISION = "requires_vision=True but model lacks vision capability"


# --- pattern sets ------------------------------------------------------------------------------


def match_patterns(text: Column, patterns=specs.SKILL_PATTERNS, flags: str = "(?iu)") -> Column:
    """Every pattern over the whole text.

    Items are distinct, in pattern order then order of appearance. Confidence grows by 0.1 per
    item from 0.5 and stops at 0.9.
    """
    found = F.array(
        *[
            F.struct(
                F.array_distinct(F.regexp_extract_all(text, F.lit(flags + p), 1)).alias("items"),
                F.lit(category).alias("category"), F.lit(f"pattern:{label or p}").alias("label"),
            )
            for p, category, label in patterns
        ]
    )
    hits = F.filter(found, lambda f: F.size(f["items"]) > 0)
    return let(hits, _summarise_hits)


def _summarise_hits(hits: Column) -> Column:
    items = F.array_distinct(F.flatten(F.transform(hits, lambda h: h["items"])))
    count = F.size(items)
    return F.struct(
        (count > 0).alias("matched"),
        items.alias("items"),
        F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["category"]))).alias("categories"),
        F.transform(hits, lambda h: h["label"]).alias("evidence"),
        F.when(count == 0, F.lit(0.0)).otherwise(F.least((F.lit(5) + count) / F.lit(10), F.lit(0.9))).alias("confidence"),
    )


# --- dictionaries ------------------------------------------------------------------------------


def normalize_key(value: Column) -> Column:
    return F.translate(F.lower(strip(value)), "-_", "  ")


def lookup(df: DataFrame, value: str, dictionary: DataFrame, key: str = "key", order: str = "ord", entry: dict[str, str] | None = None) -> DataFrame:
    """Add ``match_key, confidence`` from a dictionary ``(key, ord, ...)``, and the matched key's columns that ``entry``
    renames.

    Exact match 1.0, normalised match 0.85, else the longest dictionary key that is a prefix of
    the value or has it as a prefix (at least four characters, earliest key on a tie). All three
    are equi-joins on distinct values: prefixes are spelled out, so no pair is compared that
    does not match.
    """
    entries = dictionary.select(F.col(key).alias("match_key"), F.col(order).alias("_ord"))
    entries = entries.withColumn("_norm", normalize_key(F.col("match_key")))
    # Two keys with one normal form: the later one is kept, at the position of the first.
    normal = entries.groupBy("_norm").agg(
        F.max_by("match_key", "_ord").alias("match_key"), F.min("_ord").alias("_ord")
    )
    values = df.select(F.col(value).alias("_value")).filter(strip(F.col(value)) != "").groupBy("_value").agg(F.count("*").alias("_rows"))
    often = values.filter(F.col("_rows") > PART_ROWS).select("_value", F.ceil(F.col("_rows") / PART_ROWS).cast("int").alias("_parts"))
    values = values.select("_value")
    values = values.withColumns({"_raw": strip(F.col("_value")), "_q": normalize_key(F.col("_value"))})
    exact = (entries.select(F.col("match_key").alias("_raw"), F.col("match_key").alias("_exact")))
    near = (normal.select(F.col("_norm").alias("_q"), F.col("match_key").alias("_near")))
    known = values.join(exact, "_raw", "left").join(near, "_q", "left")
    settled = known.filter(F.col("_exact").isNotNull() | F.col("_near").isNotNull()).select(
        "_value",
        F.coalesce("_exact", "_near").alias("match_key"),
        F.when(F.col("_exact").isNotNull(), F.lit(1.0)).otherwise(F.lit(0.85)).alias("confidence"),
    )
    open_values = known.filter(F.col("_exact").isNull() & F.col("_near").isNull()).select("_value", "_q")
    heads = open_values.filter(F.length("_q") >= SHORTEST_PREFIX)
    # The value begins with a key: spell out its prefixes, never longer than the longest key.
    longest = normal.agg(F.max(F.length("_norm"))).first()[0] or 0
    stops = F.least(F.length("_q"), F.lit(longest))
    spelled = heads.filter(stops >= SHORTEST_PREFIX).select(
        "_value", "_q", F.explode(F.sequence(F.lit(SHORTEST_PREFIX), stops)).alias("_n")
    )
    begins = spelled.select("_value", "_q", "_n", F.expr("left(_q, _n)").alias("_norm")).join(
        (normal), "_norm"
    )
    begins = begins.groupBy("_value", "_q").agg(F.max_by("match_key", "_n").alias("match_key"), F.max("_n").alias("_n"))
    # A key begins with the value: one entry per spelled-out key prefix, the earliest key.
    spelled_keys = normal.filter(F.length("_norm") >= SHORTEST_PREFIX).select(
        "match_key", "_ord", "_norm",
        F.explode(F.sequence(F.lit(SHORTEST_PREFIX), F.length("_norm"))).alias("_n"),
    )
    first_keys = spelled_keys.groupBy(F.expr("left(_norm, _n)").alias("_q")).agg(
        F.min_by("match_key", "_ord").alias("match_key")
    )
    inside = heads.join((first_keys), "_q").withColumn("_n", F.length("_q"))
    both = inside.select("_value", "_q", "match_key", "_n").unionByName(begins)
    picked = (
        both.groupBy("_value", "_q")
        .agg(F.max_by("match_key", "_n").alias("match_key"), F.max("_n").alias("_n"))
        .select(
            "_value", "match_key",
            F.least(F.col("_n") / F.greatest(F.length("_q"), F.lit(1)) * 0.8, F.lit(0.75)).alias("confidence"),
        )
    )
    resolved = settled.unionByName(picked)
    if entry:
        resolved = resolved.join(dictionary.select(F.col(key).alias("match_key"), *[F.col(c).alias(n) for c, n in entry.items()]), "match_key", "left")
    # A frequent value's answer is joined in as many parts as its rows need: no value fills a task. There are at most a
    # PART_ROWS-th as many frequent values as rows. Rows are dealt to parts by what they hold.
    resolved = resolved.join(F.broadcast(often), "_value", "left")
    resolved = resolved.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    held = [F.col(f"`{n}`") for n, t in df.dtypes if t.split("<")[0] not in ("map", "variant", "array", "struct")]
    named = often.select(F.col("_value").alias("_often"), "_parts")
    dealt = df.join(F.broadcast(named), df[value] == named["_often"], "left").drop("_often")
    dealt = dealt.withColumn("_deal", F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*held), F.col("_parts").cast("long"))).otherwise(F.lit(0)).cast("int")).drop("_parts")
    out = dealt.join(resolved, (dealt[value] == resolved["_value"]) & (dealt["_deal"] == resolved["_part"]), "left").drop("_value", "_part", "_deal")
    return out.withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))


# --- field groups -------------------------------------------------------------------------------

SPEC_SCHEMA = (
    "field_group string, strategy string, platform string, subdataset string, requires_vision boolean, "
    "required array<string>, outputs array<string>, output_types array<string>, extractor string, "
    "source_key string, sources array<string>, min_confidence double"
)


def builtin_groups(spark) -> DataFrame:
    """The platform-neutral groups. The platform groups are read with ``sources.specs``."""
    rows = []
    for name, (strategy, required, outputs, config, least) in specs.FIELD_GROUPS.items():
        extractor, source = config if strategy.startswith("extractive") else (None, None)
        sources = list(config) if strategy == "passthrough" else []
        rows.append(
            (name, strategy, "", "", False, list(required), [o for o, _ in outputs], [t for _, t in outputs],
             extractor, source, sources, least)
        )
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def groups_for(registry: DataFrame, platform: str, subdatasets: list[str], vision: bool = False) -> DataFrame:
    """Groups that apply to a record: its platform and type, or no platform at all."""
    any_platform = F.col("platform") == ""
    mine = (F.col("platform") == platform) & ((F.col("subdataset") == "") | F.col("subdataset").isin(*subdatasets))
    seen = F.lit(vision) | ~F.col("requires_vision")
    return registry.filter((any_platform | mine) & seen)


def source_fields(fields: Column, required: Column) -> Column:
    """Fields a group may read: its required ones and the common text keys, filled ones only."""
    keys = F.array_distinct(F.concat(required, F.array(*[F.lit(k) for k in specs.SOURCE_TEXT_KEYS])))
    held = F.filter(
        F.transform(keys, lambda k: F.struct(k.alias("key"), F.try_element_at(fields, k).alias("value"))),
        lambda e: F.coalesce(e["value"], F.lit("")) != "",
    )
    return held


def prompt(name: Column, held: Column) -> Column:
    """Prompt of a group without a template of its own."""
    listed = F.transform(held, lambda e: F.concat(F.lit("  "), e["key"], F.lit(": "), e["value"]))
    return F.array_join(
        F.concat(
            F.array(F.concat(F.lit("Field group: "), name), F.lit("Source fields:")),
            listed,
            F.array(F.lit(""), F.lit("Return a JSON object with the enriched fields based on the source data above.")),
        ),
        "\n",
    )


def render_template(template: str, held: Column) -> Column:
    """Prompt from a template with one ``source_fields`` loop; compiled once, rendered by row."""
    out, at = [], 0
    for match in LOOP.finditer(template):
        out += _plain(template[at : match.start()], held)
        out.append(_loop(held, *match.groups()))
        at = match.end()
    out += _plain(template[at:], held)
    return strip(F.concat(*out))


def _plain(text: str, held: Column) -> list[Column]:
    """Fixed text with ``source_fields.get(name)`` references."""
    pieces = REFERENCE.split(text)
    return [F.lit(p) if i % 2 == 0 else _value_of(held, p) for i, p in enumerate(pieces)]


def _value_of(held: Column, name: str) -> Column:
    hit = F.filter(held, lambda e: e["key"] == name)
    return F.coalesce(F.try_element_at(hit, F.lit(1))["value"], F.lit(""))


def _loop(held: Column, key_name: str, value_name: str, body: str) -> Column:
    def line(entry: Column) -> Column:
        shown = F.replace(F.lit(body), F.lit("{{ " + key_name + " }}"), entry["key"])
        return F.replace(shown, F.lit("{{ " + value_name + " }}"), entry["value"])

    return F.array_join(F.transform(held, line), "")


PART = "struct<kind:string,text:string,key:string,value:string>"


def template_parts(template: str) -> list[tuple[str, str, str | None, str | None]]:
    """A template as rows: fixed text, ``source_fields.get`` references, and loops with their two names and body."""
    out, at = [], 0

    def plain(text: str) -> None:
        for i, piece in enumerate(REFERENCE.split(text)):
            if piece or i % 2:
                out.append(("field" if i % 2 else "text", piece, None, None))

    for match in LOOP.finditer(template):
        plain(template[at : match.start()])
        key, value, body = match.groups()
        out.append(("loop", body, "{{ " + key + " }}", "{{ " + value + " }}"))
        at = match.end()
    plain(template[at:])
    return out


def with_templates(registry: DataFrame, templates: dict[str, str]) -> DataFrame:
    """A registry whose groups have their own prompt template, as data: ``template`` holds its parts, null without one."""
    rows = [(group, template_parts(text)) for group, text in templates.items()]
    made = registry.sparkSession.createDataFrame(rows, f"field_group string, template array<{PART}>")
    return registry.join(F.broadcast(made), "field_group", "left")


def render_parts(parts: Column, held: Column) -> Column:
    """Prompt from the parts of a template that may differ by row."""

    def shown(part: Column) -> Column:
        line = lambda e: F.replace(F.replace(part["text"], part["key"], e["key"]), part["value"], e["value"])
        found = F.try_element_at(F.filter(held, lambda e: e["key"] == part["text"]), F.lit(1))["value"]
        return (
            F.when(part["kind"] == "text", part["text"]).when(part["kind"] == "field", F.coalesce(found, F.lit("")))
            .otherwise(F.array_join(F.transform(held, line), ""))
        )

    return strip(F.array_join(F.transform(parts, shown), ""))


def within_budget(docs: DataFrame, order: list[str], tokens: str, budget: int) -> tuple[DataFrame, DataFrame]:
    """(documents that still run, results of those that don't) under a token budget, in the order of ``order``.

    The rule looks at keys and counts only, so texts stay where they are; a document beyond the budget gets one ``skipped``
    result, for the first group it asked for. ``order`` must name one document each, and its columns may not be null.
    """
    gate = budget_gate(docs.select(*order, tokens), order, tokens, budget).select(*order, "admitted")
    marked = docs.join(gate, order)
    refused = marked.where("not admitted and size(field_groups) > 0").select(
        "doc_id", F.element_at("field_groups", 1).alias("field_group"), F.lit("skipped").alias("status"), F.lit("token budget exceeded").alias("error")
    )
    return marked.where("admitted").drop("admitted"), refused


def run_groups(
    docs: DataFrame, registry: DataFrame, dictionary: DataFrame | None = None, vision: bool = False,
    fields: str = "fields", groups: str = "field_groups",
) -> DataFrame:
    """One result per document and requested group.

    ``docs`` has ``doc_id``, a string map ``fields`` and an array ``field_groups``. The order of
    checks is vision, required fields, passthrough, extraction, then a pending prompt. Groups
    that are not in the registry are skipped. ``dictionary`` has ``key, ord, values`` (a map).
    """
    asked = docs.select("doc_id", fields, F.explode(groups).alias("field_group"))
    # The registry is a table of settings; a shuffle by group would send all texts of a group to one task.
    rows = asked.join(F.broadcast(registry), "field_group", "left")
    f = F.col(fields)
    held = source_fields(f, F.coalesce("required", F.array().cast("array<string>")))
    rows = rows.withColumn("held", held)
    # Extraction reads the named field, else all text for patterns or the first text for a lookup.
    named = F.try_element_at(F.map_from_entries("held"), F.col("source_key"))
    all_text = F.array_join(F.transform("held", lambda e: e["value"]), "\n")
    # The named key may be one the group does not list as required: read it from the document.
    keyed = first_text(named, F.try_element_at(f, F.col("source_key")))
    pattern_text = F.when(F.col("extractor") == "regex", F.coalesce(keyed, all_text))
    lookup_text = F.when(
        F.col("extractor") == "lookup", strip(F.coalesce(keyed, F.try_element_at(F.transform("held", lambda e: e["value"]), F.lit(1))))
    )
    rows = rows.withColumns({"_pattern_text": pattern_text, "_lookup_text": lookup_text})
    missed = {
        "match_key": F.lit(None).cast("string"), "confidence": F.lit(0.0), "_entry": F.lit(None).cast("map<string,string>"),
    }
    if dictionary is None:
        rows = rows.withColumns(missed)
    else:
        # Only rows with something to look up take part in the joins; texts of the others stay put.
        asking = lookup(rows.filter(F.col("_lookup_text").isNotNull()), "_lookup_text", dictionary, entry={"values": "_entry"})
        rows = rows.filter(F.col("_lookup_text").isNull()).withColumns(missed).unionByName(asking)
    nothing = "struct<matched:boolean,items:array<string>,categories:array<string>,evidence:array<string>,confidence:double>"
    patterns = F.when(F.col("_pattern_text").isNotNull(), match_patterns(F.col("_pattern_text"))).otherwise(F.lit(None).cast(nothing))
    rows = rows.withColumn("_patterns", patterns)
    regex = F.col("extractor") == "regex"
    matched = F.coalesce(F.when(regex, F.col("_patterns.matched")).otherwise(F.col("match_key").isNotNull()), F.lit(False))
    sure = F.coalesce(F.when(regex, F.col("_patterns.confidence")).otherwise(F.col("confidence")), F.lit(0.0))
    rows = rows.withColumns({"_matched": matched, "_confidence": sure})
    required_ok = F.forall(
        F.coalesce("required", F.array().cast("array<string>")),
        lambda k: F.coalesce(F.try_element_at(f, k), F.lit("")) != "",
    )
    passed = F.filter("sources", lambda k: F.coalesce(F.try_element_at(f, k), F.lit("")) != "")
    strategy = F.col("strategy")
    extracts = strategy.isin("extractive_only", "extractive_then_generative")
    enough = F.col("_matched") & (F.col("_confidence") >= F.coalesce("min_confidence", F.lit(0.8)))
    status = (
        F.when(strategy.isNull(), F.lit("skipped"))
        .when(F.col("requires_vision") & F.lit(not vision), F.lit("skipped"))
        .when(~required_ok, F.lit("skipped"))
        .when((strategy == "passthrough") & (F.size(passed) > 0), F.lit("success"))
        .when(strategy == "passthrough", F.lit("skipped"))
        .when(extracts & enough, F.lit("success"))
        .when((strategy == "extractive_only") & F.col("_matched"), F.lit("partial"))
        .when(strategy == "extractive_only", F.lit("failed"))
        .otherwise(F.lit("pending_agent"))
    )
    error = (
        F.when(strategy.isNull(), F.concat(F.lit("unknown field group: "), F.col("field_group")))
        .when(F.col("requires_vision") & F.lit(not vision), F.lit(SKIP_VISION))
        .when(~required_ok, missing_source_error(f, F.col("field_group"), F.col("platform"), F.col("subdataset"), F.col("required")))
        .when((strategy == "passthrough") & (F.size(passed) == 0), F.concat(F.lit("no routable source fields for "), F.col("field_group")))
        .when((strategy == "extractive_only") & ~F.col("_matched"), F.lit("no extractive match found"))
    )
    done = rows.withColumns({"status": status, "error": error, "_passed": F.try_element_at(passed, F.lit(1))})
    shown = F.array_join(F.col("_patterns.items"), ",")
    kinds = F.array_join(F.col("_patterns.categories"), ",")

    def output(name: Column) -> Column:
        from_dictionary = F.coalesce(F.try_element_at("_entry", name), F.try_element_at("_entry", F.lit("value")), F.try_element_at(F.map_values("_entry"), F.lit(1)))
        # A category output takes the categories, any other output the items.
        from_patterns = F.when(F.contains(name, F.lit("categor")), kinds).otherwise(shown)
        value = (
            F.when(strategy == "passthrough", F.try_element_at(f, F.col("_passed")))
            .when(regex, from_patterns)
            .otherwise(from_dictionary)
        )
        return F.when(F.col("status").isin("success", "partial"), value)

    outputs = F.map_from_entries(
        F.filter(
            F.transform("outputs", lambda o: F.struct(o.alias("key"), output(o).alias("value"))), lambda e: e["value"].isNotNull()
        )
    )
    pending = F.col("status") == "pending_agent"
    found_any = F.col("status").isin("success", "partial")
    own_prompt = prompt(F.col("field_group"), F.col("held"))
    if "template" in registry.columns:
        own_prompt = F.when(F.col("template").isNotNull(), render_parts(F.col("template"), F.col("held"))).otherwise(own_prompt)
    return done.select(
        "doc_id", "field_group", "status", "error",
        F.when(F.col("status").isin("success", "partial"), outputs).alias("values"),
        F.when(F.col("status").isin("success", "partial"), F.when(strategy == "passthrough", F.lit(0.6)).otherwise(F.col("_confidence"))).alias("confidence"),
        F.when(pending, own_prompt).alias("agent_prompt"),
        F.when(pending, F.col("outputs")).alias("output_fields"),
        F.when(found_any, F.when(strategy == "passthrough", F.lit("passthrough")).when(F.col("extractor") == "lookup", F.lit("lookup")).otherwise(F.lit("extractive"))).alias("source_type"),
        F.when(found_any, F.when(strategy == "passthrough", F.array(F.concat(F.lit("source_field:"), F.element_at(passed, 1)))).when(regex, F.col("_patterns.evidence")).otherwise(F.array(F.concat(F.lit("lookup:"), F.col("match_key"))))).alias("evidence"),
    )


def missing_source_error(fields: Column, group: Column, platform: Column, subdataset: Column, required: Column) -> Column:
    """Why a group was skipped; a sold-out product explains a missing price."""
    sold_out = F.coalesce(F.try_element_at(fields, F.lit("availability")), F.lit("")).rlike(
        "(?i)unavailable|out of stock|currently unavailable|目前无货|無貨"
    )
    priced = (platform == "amazon") & (subdataset == "products") & F.array_contains(required, "price") & sold_out
    tail = F.lit(" unavailable on source page (product unavailable or no offer data)")
    subject = F.when(group == "amazon_products_pricing", F.lit("pricing")).otherwise(F.lit("price-dependent analysis"))
    names = F.concat(F.lit("['"), F.array_join(required, "', '"), F.lit("']"))
    return F.when(priced, F.concat(subject, tail)).otherwise(F.concat(F.lit("missing required source fields: "), names))


def cache_key(group: Column, url: Column, platform: Column, kind: Column, text: Column, markdown: Column, structured: Column) -> Column:
    """Content hash under which a finished result can be reused."""
    parts = F.struct(
        url.alias("canonical_url"), group.alias("field_group"), markdown.alias("markdown"), text.alias("plain_text"),
        platform.alias("platform"), kind.alias("resource_type"), structured.alias("structured"),
    )
    return F.sha2(F.to_json(parts), 256)


def reuse_cached(rows: DataFrame, cache: DataFrame, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """Rows answered by the cache, and rows still to run."""
    return rows.join(cache, key), rows.join(cache.select(key), key, "left_anti")


def cacheable(results: DataFrame) -> DataFrame:
    """Results worth keeping: not failed, not skipped, not waiting for an answer."""
    return results.filter(~F.col("status").isin("failed", "skipped", "pending_agent"))


def parse_answer(text: Column) -> Column:
    """JSON object of an answer as a string map; anything else is kept under ``raw``."""
    parsed = F.from_json(unfence(text), "map<string,string>")
    is_object = F.startswith(unfence(text), F.lit("{")) & F.is_variant_null(F.try_parse_json(unfence(text))).isNotNull()
    return F.when(is_object & parsed.isNotNull(), parsed).otherwise(F.create_map(F.lit("raw"), text))


def fill_pending(results: DataFrame, responses: DataFrame, ids: list[str]) -> DataFrame:
    """Fill pending results from ``responses(key, response)`` keyed ``{id}:{field_group}``.

    ``ids`` are the id columns to try, best first. Other results pass through unchanged.
    """
    out = results
    keyed = responses.groupBy("key").agg(F.max("response").alias("response"))
    answers = []
    for i, name in enumerate(ids):
        side = keyed.select(F.col("key").alias(f"_key{i}"), F.col("response").alias(f"_answer{i}"))
        wanted = F.when(F.col("status") == "pending_agent", F.concat_ws(":", F.col(name), F.col("field_group")))
        out = out.withColumn("_wanted", wanted)
        out = out.join(side, out["_wanted"] == side[f"_key{i}"], "left").drop("_wanted", f"_key{i}")
        answers.append(F.col(f"_answer{i}"))
    out = out.withColumn("_answer", F.coalesce(*answers)).drop(*[f"_answer{i}" for i in range(len(ids))])
    parsed = parse_answer(F.col("_answer"))
    names = F.coalesce("output_fields", F.array().cast("array<string>"))
    out = out.withColumn("_parsed", parsed)
    values = F.map_from_entries(
        F.filter(
            F.transform(
                names,
                lambda n: F.struct(
                    n.alias("key"),
                    F.coalesce(F.try_element_at("_parsed", n), F.try_element_at("_parsed", F.lit("raw"))).alias("value"),
                ),
            ),
            lambda e: e["value"].isNotNull(),
        )
    )
    answered = F.col("_answer").isNotNull()
    out = out.withColumn("_filled", values)
    good = F.size("_filled") > 0
    return out.withColumns(
        {
            "status": F.when(answered, F.when(good, F.lit("success")).otherwise(F.lit("failed"))).otherwise(F.col("status")),
            "values": F.when(answered, F.col("_filled")).otherwise(F.col("values")),
            "confidence": F.when(answered, F.when(good, F.lit(0.8)).otherwise(F.lit(0.0))).otherwise(F.col("confidence")),
        }
    ).drop("_answer", "_parsed", "_filled")


def merge_fields(results: DataFrame, order: str) -> DataFrame:
    """Enriched fields per document and name: the last group that set one wins."""
    rows = results.select("doc_id", F.col(order).alias("_ord"), F.explode("values").alias("field_name", "value"))
    return rows.groupBy("doc_id", "field_name").agg(F.max_by("value", "_ord").alias("value"))


def overlay_filled(old: Column, new: Column) -> Column:
    """Map overlay that ignores null values of the new map."""
    return overlay(old, F.map_filter(new, lambda _, v: v.isNotNull()))

