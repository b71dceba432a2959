"""Submission projection, schema projection, report rows and artifact manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.text import strip
from pagemill.functions.values import first_text


def cleaned_text(plain: Column, cleaned: Column, markdown: Column) -> Column:
    """Plain text, else cleaned data, else markdown, else the empty string."""
    return F.coalesce(first_text(plain, cleaned, markdown), F.lit(""))


def submission_entries(
    records: DataFrame, dataset_id: str | Column, generated_at: Column | None = None, strict: bool = True
) -> DataFrame:
    """Records, as a crawl writes them, as submission entries; columns they lack count as empty.

    A record without an address or a time stamp fails the job when ``strict``; otherwise it is
    left out of the entries and can be listed with ``rejected_entries``.
    """
    fallback = F.lit(None).cast("string") if generated_at is None else generated_at
    lacking = [c for c in ("canonical_url", "url", "plain_text", "cleaned_data", "markdown", "structured", "crawl_timestamp") if c not in records.columns]
    records = records.withColumns({c: F.lit(None).cast("string") for c in lacking})
    url = strip(F.coalesce(first_text(F.col("canonical_url"), F.col("url")), F.lit("")))
    stamp = strip(F.coalesce(first_text(F.col("crawl_timestamp"), fallback), F.lit("")))
    out = records.select(
        (F.lit(dataset_id) if isinstance(dataset_id, str) else dataset_id).alias("dataset_id"),
        url.alias("url"),
        cleaned_text(F.col("plain_text"), F.col("cleaned_data"), F.col("markdown")).alias("cleaned_data"),
        F.coalesce(F.col("structured"), F.lit("{}")).alias("structured_data"),
        stamp.alias("crawl_timestamp"),
    )
    if not strict:
        return out.filter((F.col("url") != "") & (F.col("crawl_timestamp") != ""))
    problem = F.when(F.col("url") == "", F.lit("record is missing canonical_url")).when(
        F.col("crawl_timestamp") == "",
        F.concat(F.lit("record "), F.col("url"), F.lit(" is missing crawl_timestamp and no fallback was given")),
    )
    checked = F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.col("url"))
    return out.withColumn("url", checked)


def submission_requests(entries: DataFrame, entries_per_request: int = 500) -> DataFrame:
    """Entries packed into requests of at most ``entries_per_request``.

    Entries are sorted by dataset and address over all tasks; each task fills requests one after the other, so only
    a task's last request of a dataset can be short. No dataset and no hot address is gathered in one task.
    """
    blocks = entries.repartitionByRange("dataset_id", "url").withColumn("_block", F.spark_partition_id())
    place = Window.partitionBy("dataset_id", "_block").orderBy("url")
    number = F.floor((F.row_number().over(place) - 1) / entries_per_request)
    numbered = blocks.withColumn("request", F.call_function("shiftleft", F.col("_block").cast("long"), F.lit(32)) + number)
    entry = F.struct("url", "cleaned_data", "structured_data", "crawl_timestamp")
    return numbered.groupBy("dataset_id", "_block", "request").agg(F.collect_list(entry).alias("entries")).drop("_block")


def project_to_schema(entries: DataFrame, schema: dict[str, bool], values: Column, resolved: Column) -> DataFrame:
    """Keep the fields a dataset asks for.

    ``schema`` maps a field to whether it is required. A filled structured value is taken as it
    is; a missing optional field is left out; anything else is looked up in ``resolved``.
    """
    pairs = []
    for name, required in schema.items():
        own = F.nullif(F.try_element_at(values, F.lit(name)), F.lit(""))
        other = F.nullif(F.try_element_at(resolved, F.lit(name)), F.lit(""))
        allowed = F.lit(required) | F.map_contains_key(values, F.lit(name))
        pairs.append(F.struct(F.lit(name).alias("key"), F.coalesce(own, F.when(allowed, other)).alias("value")))
    kept = F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())
    return entries.withColumn("structured_data", F.map_from_entries(kept))


def resolve_fields(entry_url: Column, record: Column, metadata: Column, values: Column, cleaned: Column, item_url: Column) -> Column:
    """Candidate values of schema fields: fixed candidates, structured, metadata, record."""

    def get(mapping: Column, name: str) -> Column:
        return F.try_element_at(mapping, F.lit(name))

    fixed = F.create_map(
        F.lit("url"), first_text(entry_url, get(record, "canonical_url"), get(record, "url"), item_url),
        F.lit("title"), first_text(get(values, "title"), get(record, "title"), get(metadata, "title"), get(metadata, "page_title")),
        F.lit("content"), first_text(get(values, "content"), cleaned),
        F.lit("cleaned_data"), cleaned,
        F.lit("canonical_url"), first_text(get(record, "canonical_url"), item_url),
    )

    def under(low: Column, high: Column) -> Column:
        return F.map_concat(F.map_filter(low, lambda k, _: ~F.map_contains_key(high, k)), high)

    return under(under(under(record, metadata), values), fixed)


def fetch_artifacts(slug: Column, root: str = "artifacts") -> Column:
    """Manifest of what a fetched row leaves behind: kind, path, content type.

    Expects ``backend, json_data, html, content_type, has_screenshot`` columns.
    """
    api = (F.col("backend") == "api") | F.col("json_data").isNotNull()
    base = F.concat(F.lit(root + "/"), slug, F.lit("/"))

    def item(kind: str, name: str, kind_of: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.concat(base, F.lit(name)).alias("path"), kind_of.alias("content_type")
        )

    written_as = F.coalesce(F.nullif("content_type", F.lit("")), F.lit("text/html"))
    items = F.array(
        F.when(F.col("json_data").isNotNull() & api, item("api_response", "api_response.json", F.lit("application/json"))),
        F.when(~api & (F.coalesce(F.col("html"), F.lit("")) != ""), item("html", "page.html", written_as)),
        F.when(F.col("has_screenshot"), item("screenshot", "screenshot.png", F.lit("image/png"))),
        item("fetch", "fetch.json", F.lit("application/json")),
    )
    return F.filter(items, lambda x: x.isNotNull())


def extraction_artifacts(slug: Column, root: str = "artifacts") -> Column:
    """Manifest of an extracted row. Expects ``cleaned_html, has_pdf, parser_metadata`` columns."""
    base = F.concat(F.lit(root + "/"), slug, F.lit("/"))

    def item(kind: str, name: str, kind_of: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.concat(base, F.lit(name)).alias("path"), F.lit(kind_of).alias("content_type")
        )

    items = F.array(
        item("markdown", "content.md", "text/markdown"),
        item("plain_text", "content.txt", "text/plain"),
        F.when(F.coalesce(F.col("cleaned_html"), F.lit("")) != "", item("cleaned_html", "cleaned.html", "text/html")),
        F.when(
            F.col("parser_metadata").isNotNull(),
            item("parser_metadata", "parser_metadata.json", "application/json"),
        ),
        F.when(F.col("has_pdf"), item("raw_pdf", "source.pdf", "application/pdf")),
        item("chunks", "chunks.json", "application/json"),
        item("structured", "structured.json", "application/json"),
    )
    return F.filter(items, lambda x: x.isNotNull())
