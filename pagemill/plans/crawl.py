"""Fetched pages to canonical records, errors and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import page_fields as P
from pagemill.functions import payloads as J
from pagemill.functions import policy
from pagemill.functions import url as U
from pagemill.functions.arrays import let
from pagemill.functions.platform_urls import normalize_network
from pagemill.functions.text import doc_id
from pagemill.functions.values import overlay
from pagemill.operators import chunk as C
from pagemill.operators import content as K
from pagemill.operators.keyed import keep_first, without_keys
from pagemill.operators.reduce import reduce_sections, section, sections_markdown, sections_text

RECORD = (
    "doc_id", "platform", "resource_type", "canonical_url", "title", "description", "plain_text", "markdown",
    "sections", "selector_used", "chunking_strategy", "content_ratio", "noise_removed", "field_sources", "structured",
)


def prepare(pages: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Canonical addresses, first page per address, without what an earlier run completed.

    Both steps come before parsing: nothing moves across the Python step on its own.
    """
    out = pages
    for name, default in (("platform", "generic"), ("resource_type", "page"), ("content_type", "text/html"), ("json_data", None)):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(default).cast("string"))
    if "canonical_url" not in out.columns:
        out = out.withColumn("canonical_url", U.without_query(F.col("url")))
    order = "page_id" if "page_id" in out.columns else "url"
    out = keep_first(out, ["canonical_url"], [order])
    return out if done is None else without_keys(out, done, ["canonical_url"])


def classify(pages: DataFrame) -> DataFrame:
    """Add the content problem of every HTML page; API and XML payloads have none."""
    is_page = F.col("json_data").isNull() & ~(F.col("content_type").contains("xml") & ~F.col("content_type").contains("html"))
    return pages.withColumn(
        "problem", F.when(is_page, policy.classify_content(F.col("html"), F.col("canonical_url"))).otherwise(policy.no_error())
    )


def page_structured(nodes: Column, url: Column, platform: Column, kind: Column, variants: Column, css_schema: dict | None = None) -> Column:
    """The platform's fields of a page as JSON text; other platforms give the page metadata.

    ``variants`` are a product's priced variants. With a CSS schema its values stand beside the fields under ``css``. Only
    the row's own branch is computed.
    """
    found = (
        F.when((platform == "amazon") & (kind == "seller"), F.to_json(P.seller_fields(nodes, url)))
        .when(platform == "amazon", F.to_json(let(P.product_fields(nodes, url), lambda p: p.withField("price", F.coalesce(p["price"], F.col("_price")))).withField("variants", variants)))
        .when(platform == "base", F.to_json(P.explorer_fields(nodes, kind)))
        .when((platform == "linkedin") & (kind == "search"), F.to_json(F.struct(P.search_results(nodes).alias("results"))))
        .otherwise(F.to_json(F.col("_meta")))
    )
    if css_schema is None:
        return found
    css = F.parse_json(F.to_json(P.css_fields(nodes, css_schema, url)))
    own = F.map_filter(F.from_json(found, "map<string,variant>"), lambda k, _: k != "css")
    return F.to_json(F.map_concat(own, F.create_map(F.lit("css"), css)))


def from_html(pages: DataFrame, css_schema: dict | None = None) -> DataFrame:
    """HTML branch: main content, reduction, sections, metadata, structured fields."""
    parsed = K.extract_pages(pages, url="canonical_url")
    meta = P.page_meta(F.col("nodes"), F.col("canonical_url"))
    # Only product pages have variant slots; the markup inside them is parsed in a step of its own, which others pass empty.
    is_product = (F.col("platform") == "amazon") & (F.col("resource_type") != "seller")
    none = F.array().cast(f"array<struct<{J.VARIANT_SLOT.replace(' string', ':string')}>>")
    parsed = parsed.withColumn("_slots", F.when(is_product, J.variant_slots(P.variant_responses(F.col("nodes")))).otherwise(none))
    parsed = parsed.withColumn("_objects", F.when(is_product, P.script_objects(F.col("nodes"))).otherwise(F.array().cast("array<string>")))
    parsed = parsed.withColumns({
        "_prices": P.slot_prices(F.col("_slots")), "_embedded": J.embedded_variants(F.col("_objects")), "_price": J.embedded_price(F.col("_objects"))
    })
    variants = P.priced_variants(F.col("nodes"), F.col("_slots"), F.col("_prices"), F.col("_embedded"))
    fields = page_structured(F.col("nodes"), F.col("canonical_url"), F.col("platform"), F.col("resource_type"), variants, css_schema)
    return parsed.withColumn("_meta", meta).select(
        *[c for c in pages.columns], "doc_id", "plain_text", "markdown", "sections", "selector_used", "noise_removed",
        "content_ratio", F.col("_meta.title").alias("title"), F.col("_meta.description").alias("description"),
        F.col("_meta.field_sources").alias("field_sources"), F.lit("hybrid").alias("chunking_strategy"),
        fields.alias("structured"),
    )


def _from_text(pages: DataFrame, title: Column, description: Column, plain: Column, markdown: Column, sources: Column, how: str, structured: Column) -> DataFrame:
    """Payload branches: one section, reduced like any other."""
    lone = section(plain, markdown, title, F.lit(1), F.array(F.coalesce(title, F.lit("Main"))))
    out = pages.withColumn("sections", reduce_sections(F.array(lone)))
    return out.select(
        *pages.columns, doc_id(F.col("canonical_url"), F.col("platform")).alias("doc_id"),
        sections_text(F.col("sections")).alias("plain_text"), sections_markdown(F.col("sections")).alias("markdown"),
        "sections", F.lit(how).alias("selector_used"), F.lit(0).alias("noise_removed"),
        (F.length(sections_text(F.col("sections"))) / F.greatest(F.length(F.coalesce("json_data", "html")), F.lit(1))).alias("content_ratio"),
        title.alias("title"), description.alias("description"), sources.alias("field_sources"), F.lit(how).alias("chunking_strategy"),
        structured.alias("structured"),
    )


def from_json(pages: DataFrame) -> DataFrame:
    """JSON branch: encyclopedia, chain and network answers by their own rule, others as title, description, scalar fields."""
    payload, platform = F.col("json_data"), F.col("platform")
    article = (platform == "wikipedia") & J.at(payload, "$.query.pages").isNotNull()
    answer = (platform == "base") & J.at(payload, "$.result").isNotNull()
    entity = platform == "linkedin"
    named = F.try_element_at(F.map_values(normalize_network(F.col("canonical_url"))["identity"]), F.lit(1))
    rows = pages.withColumns({"_g": J.generic_json(payload), "_w": J.encyclopedia_document(payload), "_n": F.when(entity, J.network_document(payload, F.col("resource_type"), named))})
    fields = F.map_filter(J.as_map(payload), lambda k, _: ~k.isin("title", "name", "description", "summary", "data"))
    rows = rows.withColumn("_d", J.render_document(F.col("_g.title"), F.col("_g.description"), fields))
    result = J.at(payload, "$.result")

    def routed(of_article: Column, of_answer: Column, of_entity: Column, other: Column) -> Column:
        return F.when(article, of_article).when(answer, of_answer).when(entity, of_entity).otherwise(other)

    title = routed(F.col("_w.title"), F.col("resource_type"), F.col("_n.title"), F.col("_g.title"))
    own = F.when(article | answer | entity, F.concat(F.lit("legacy_platform:"), platform))
    sources = F.when(own.isNull(), F.col("_g.field_sources")).otherwise(F.create_map(F.lit("title"), own, F.lit("description"), own))
    out = _from_text(
        rows, title,
        routed(F.coalesce(F.nullif("_w.description", F.lit("")), "_w.plain_text"), result, F.col("_n.plain_text"), F.col("_g.description")),
        routed(F.col("_w.plain_text"), result, F.col("_n.plain_text"), F.col("_d.plain_text")),
        routed(
            F.concat(F.lit("# "), title, F.lit("\n\n"), F.col("_w.plain_text")), F.concat(F.lit("```json\n"), result, F.lit("\n```")),
            F.col("_n.markdown"), F.col("_d.markdown"),
        ),
        sources, "json_structured",
        routed(
            F.to_json(F.struct("_w.categories", "_w.page_id")), F.to_json(F.struct(result.alias("rpc_result"))),
            F.to_json(overlay(
                F.from_json(F.col("_n.structured"), "map<string,variant>"),
                F.map_filter(F.from_json(F.to_json(F.struct("_n.entity_type", "_n.source_id", "_n.published_at")), "map<string,variant>"), lambda _, v: v.isNotNull()),
            )),
            F.to_json(fields),
        ),
    )
    return out.drop("_g", "_d", "_w", "_n")


def from_atom(pages: DataFrame) -> DataFrame:
    """XML branch of the preprint platform."""
    rows = pages.withColumn("_p", J.paper(F.col("html"), F.col("canonical_url")))
    sources = F.create_map(F.lit("title"), F.lit("xml:title"), F.lit("description"), F.lit("xml:summary"))
    out = _from_text(
        rows, F.col("_p.title"), F.col("_p.description"), F.col("_p.raw_text"), F.col("_p.markdown"), sources, "xml_structured",
        F.to_json(F.col("_p")),
    )
    return out.drop("_p")


def extract(pages: DataFrame, formats: tuple[str, ...] = ("html", "json", "atom"), css_schema: dict | None = None) -> DataFrame:
    """Route every page to its branch; each branch only reads its own rows."""
    is_json = F.col("json_data").isNotNull()
    is_atom = ~is_json & F.col("content_type").contains("xml") & (F.col("platform") == "arxiv")
    branches = {
        "html": lambda: from_html(pages.filter(~is_json & ~is_atom), css_schema),
        "json": lambda: from_json(pages.filter(is_json)),
        "atom": lambda: from_atom(pages.filter(is_atom)),
    }
    out = None
    for name in formats:
        part = branches[name]().select(*RECORD)
        out = part if out is None else out.unionByName(part)
    return out


def add_chunks(records: DataFrame, max_tokens: int = C.MAX_TOKENS, min_tokens: int = C.MIN_TOKENS, overlap: int = C.OVERLAP_TOKENS) -> DataFrame:
    """Add the chunk pieces of every record and their number."""
    pieces = C.section_pieces(F.col("sections"), max_tokens, min_tokens, overlap)
    return records.withColumn("chunks", pieces).withColumn("total_chunks", F.size("chunks"))


def crawl_records(
    pages: DataFrame, done: DataFrame | None = None, formats: tuple[str, ...] | None = None, css_schema: dict | None = None
) -> DataFrame:
    """Records and errors of one run, told apart by ``status``."""
    given = pages.columns
    checked = classify(prepare(pages, done))
    if formats is None:
        formats = ("html",) + (("json",) if "json_data" in given else ()) + (("atom",) if "content_type" in given else ())
    good = add_chunks(extract(checked.filter(F.col("problem").isNull()), formats, css_schema)).withColumns(
        {
            "status": F.lit("success"), "stage": F.lit("normalized"), "error_code": F.lit(None).cast("string"),
            "retryable": F.lit(False), "next_action": F.lit("none"), "message": F.lit(None).cast("string"),
        }
    )
    row = policy.error_row(F.col("platform"), F.col("resource_type"), "fetch", F.col("problem"))
    bad = checked.filter(F.col("problem").isNotNull()).select("canonical_url", row.alias("e")).select("canonical_url", "e.*")
    return good.unionByName(bad, allowMissingColumns=True)


def split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and errors."""
    failed = F.col("status") == "failed"
    return records.filter(~failed), records.filter(failed)

