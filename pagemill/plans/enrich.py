"""Enrichment of records, and filling in answers later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators import alias as A
from pagemill.operators import enrich as E
from pagemill.operators.cache import add_to_cache, read_cache
from pagemill.operators.keyed import keep_first
from pagemill.session import cut_lineage

# Groups a record gets when none are asked for.
DEFAULT_GROUPS = {
    "wikipedia": ("summaries", "wikipedia_multi_level_summary", "wikipedia_relations"),
    "base": ("base_addresses_basic", "base_addresses_activity", "base_transactions_basic"),
    "linkedin": ("linkedin_profiles_identity", "linkedin_profiles_current_role", "linkedin_profiles_about"),
    "generic": ("summaries",),
}
# Groups of commerce records by their type, and the stems of their names; other types get none.
COMMERCE_GROUPS = {
    "product": ("amazon_products_", "identity pricing description category visual availability competition reviews_summary variants compliance "
                "multimodal_images multi_level_summary market_positioning listing_quality linkable_ids"),
    "review": ("amazon_reviews_", "identity content analysis quality structured media multimodal_images multi_level_summary review_depth"),
    "seller": ("amazon_sellers_", "identity performance portfolio business_intel multi_level_summary linkable_ids"),
}
#: Plural names of record types in the registry.
SUBDATASETS = {
    "product": "products", "review": "reviews", "seller": "sellers", "transaction": "transactions", "address": "addresses",
    "contract": "contracts", "profile": "profiles", "company": "company", "job": "jobs", "post": "posts", "defi": "defi",
}


def route_groups(platform: Column, requested: list[str], kind: Column | None = None) -> Column:
    """Requested groups, else those of the platform (commerce: of the record's type ``kind``), else ``summaries``."""
    if requested:
        return F.array(*[F.lit(g) for g in requested])
    out = F.array(F.lit("summaries"))
    for name, groups in DEFAULT_GROUPS.items():
        out = F.when(platform == name, F.array(*[F.lit(g) for g in groups])).otherwise(out)
    if kind is None:
        return out
    commerce = F.array().cast("array<string>")
    for name, (stem, groups) in COMMERCE_GROUPS.items():
        commerce = F.when(kind == name, F.array(*[F.lit(stem + g) for g in groups.split()])).otherwise(commerce)
    return F.when(platform == "amazon", commerce).otherwise(out)


def enrichment_documents(records: DataFrame, requested: list[str]) -> DataFrame:
    """Records as ``doc_id, fields, field_groups``."""
    names = [c for c, t in records.dtypes if t in ("string", "int", "bigint", "double", "boolean") and c != "structured"]
    own = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))])
    empty = F.create_map().cast("map<string,string>")
    structured = A.flatten_json(F.col("structured")) if "structured" in records.columns else empty
    parts = records.select(own.alias("own"), structured.alias("flat"))
    rows = parts.select(A.apply_aliases(A.enrichment_input(F.col("own"), F.col("flat"), empty)).alias("fields"))
    platform, kind = F.try_element_at("fields", F.lit("platform")), F.try_element_at("fields", F.lit("resource_type"))
    return rows.select(
        F.try_element_at("fields", F.lit("doc_id")).alias("doc_id"), "fields", route_groups(platform, requested, kind).alias("field_groups")
    )


def enrich_records(
    records: DataFrame, registry: DataFrame, dictionary: DataFrame | None = None, requested: list[str] | None = None, vision: bool = False
) -> DataFrame:
    """One result row per record and group. Groups that need a model wait with their prompt."""
    docs = enrichment_documents(records, requested or [])
    return E.run_groups(docs, registry, dictionary, vision)


def enrich_cached(
    docs: DataFrame, registry: DataFrame, cache: str, batch: str, complete, dictionary: DataFrame | None = None, vision: bool = False
) -> DataFrame:
    """Results of every document and group, asking the model only for what no earlier batch has answered.

    ``docs`` has ``doc_id``, a string map ``fields`` and an array ``field_groups``. Equal requests (group, address, platform,
    type and content) share one key: within a batch they are asked once, and what is finished is kept under ``cache``.
    ``reused`` says that a result came from an earlier batch. The outcome is written before it is returned, so the model
    isn't asked again when the result is read twice.
    """
    field = lambda name: F.try_element_at("fields", F.lit(name))
    kind = F.coalesce(field("resource_type"), field("entity_type"))
    key = E.cache_key(F.col("field_group"), field("canonical_url"), field("platform"), kind, field("plain_text"), field("markdown"), field("structured"))
    asked = docs.select("doc_id", "fields", F.explode("field_groups").alias("field_group")).withColumn("cache_key", key)
    keys = cut_lineage(asked.select("doc_id", "field_group", "cache_key"))
    kept = cut_lineage(read_cache(keys.select("cache_key"), cache))
    known = keys.join(kept, "cache_key").withColumn("reused", F.lit(True))
    # One request for each key; its answer goes to every document that has the key.
    missing = keep_first(asked.join(kept.select("cache_key"), "cache_key", "left_anti"), ["cache_key"], ["doc_id"])
    requests = missing.select(F.col("cache_key").alias("doc_id"), "fields", F.array("field_group").alias("field_groups"))
    results = cut_lineage(E.run_groups(requests, registry, dictionary, vision))
    filled = cut_lineage(E.fill_pending(results, answer_pending(results, complete), ["doc_id"]).withColumnRenamed("doc_id", "cache_key"))
    add_to_cache(filled, cache, batch)
    fresh = keys.join(filled.drop("field_group"), "cache_key").withColumn("reused", F.lit(False))
    names = ["doc_id", "field_group", "status", "values", "confidence", "reused"]
    return known.select(*names, F.lit(None).cast("string").alias("error")).unionByName(fresh.select(*names, "error"))


def enrich_within_budget(
    docs: DataFrame, registry: DataFrame, order: list[str], tokens: str, budget: int, dictionary: DataFrame | None = None, vision: bool = False
) -> DataFrame:
    """``run_groups`` for the documents that a token budget admits, and a skipped result for each of the others."""
    running, refused = E.within_budget(docs, order, tokens, budget)
    return E.run_groups(running, registry, dictionary, vision).unionByName(refused, allowMissingColumns=True)


def answer_pending(results: DataFrame, complete) -> DataFrame:
    """Rows ``key, response`` from a caller-supplied model.

    ``complete`` maps a pandas Series of prompts to one of answers; it runs in Arrow batches on
    the rows that still wait, never on the others.
    """
    asked = F.pandas_udf(complete, "string")
    waiting = results.filter(F.col("status") == "pending_agent")
    return waiting.select(F.concat_ws(":", "doc_id", "field_group").alias("key"), asked("agent_prompt").alias("response"))


def fill(results: DataFrame, responses: DataFrame) -> DataFrame:
    return E.fill_pending(results, responses, ["doc_id"])
