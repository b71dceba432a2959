"""The batch chain: input records to addresses, their fetched pages, canonical records, enrichment and submission entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import policy
from pagemill.operators import export as X
from pagemill.operators.alias import candidates
from pagemill.operators.keyed import keep_first, without_keys
from pagemill.plans.crawl import crawl_records
from pagemill.plans.enrich import enrich_records
from pagemill.session import cut_lineage


def _error(code: str, action: str, message: Column, retryable: bool) -> Column:
    return F.struct(
        F.lit(code).alias("error_code"), F.lit(action).alias("agent_hint"), message.alias("message"), F.lit(retryable).alias("retryable"),
        F.lit(None).cast("int").alias("status_code"),
    )


def joined_with_pages(records: DataFrame, pages: DataFrame, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages to crawl, error rows) of input records (a string map ``record``) and a table of fetched pages (url, html, ...).

    A record's address is given or built from its fields. Records of one address count once, the first one's platform and
    type decide; what ``done`` (canonical_url) holds is left out. Errors are records without an address and addresses
    without a page. Of several pages of one url one counts.
    """
    given = candidates(records.withColumn("_row", F.monotonically_increasing_id()))
    row = lambda stage, error: policy.error_row(F.col("platform"), F.col("resource_type"), stage, error)
    refused = given.where("error is not null or canonical_url is null").select(
        "canonical_url", row("discover", _error("INVALID_INPUT", "inspect", F.coalesce("error", F.lit("no address")), False)).alias("e")
    )
    unique = keep_first(given.where("error is null and canonical_url is not null"), ["canonical_url"], ["_row"]).select("canonical_url", "platform", "resource_type", "_row")
    if done is not None:
        unique = without_keys(unique, done, ["canonical_url"])
    bodies = keep_first(pages, ["url"], ["html"]).drop("platform", "resource_type", "canonical_url", "page_id")
    lost = unique.join(bodies.select("url"), F.col("canonical_url") == F.col("url"), "left_anti").select(
        "canonical_url", row("fetch", _error("PAGE_NOT_FOUND", "skip", F.lit("no fetched page"), False)).alias("e")
    )
    found = unique.join(bodies, F.col("canonical_url") == F.col("url")).withColumnRenamed("_row", "page_id")
    return found, refused.unionByName(lost).select("canonical_url", "e.*")


def run_batch(
    records: DataFrame, pages: DataFrame, registry: DataFrame, dataset_id: str, generated_at: Column, done: DataFrame | None = None,
    requested: list[str] | None = None, dictionary: DataFrame | None = None, css_schema: dict | None = None, formats: tuple[str, ...] | None = None,
) -> dict[str, DataFrame]:
    """``results`` (records and errors by status), ``enrichment`` (a row per record and group) and ``entries`` of one batch."""
    found, errors = joined_with_pages(records, pages, done)
    # Three tables are made of the results, so they are computed once.
    results = cut_lineage(crawl_records(found, formats=formats, css_schema=css_schema).unionByName(errors, allowMissingColumns=True))
    good = results.where("status = 'success'")
    enrichment = enrich_records(good.drop("chunks", "sections", "field_sources"), registry, dictionary, requested)
    return {"results": results, "enrichment": enrichment, "entries": X.submission_entries(good, dataset_id, generated_at)}
