"""Traversal of a page table that holds several platforms, each page by the link rule of its own platform.

Pages are read once and become a narrow edge table (no markup): who leads where, as what, in which order. The frontier then
walks keys only, so neither a level nor a checkpoint holds a page body.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions import platform_urls as P
from pagemill.functions import url as U
from pagemill.functions.arrays import first_occurrences, let
from pagemill.operators.chunk import explode_once
from pagemill.operators.keyed import keep_first
from pagemill.operators.links import SCORES, page_links
from pagemill.session import cut_lineage

KEY = ["platform", "canonical_url"]

# How each platform's candidates are said to have been found.
MODES = {
    "generic": "page_links", "wikipedia": "api_lookup", "amazon": "search_results", "linkedin": "search_results",
    "arxiv": "page_links", "base": "page_links",
}
# Kinds of network addresses by what stands in them, and the addresses embedded in markup.
NETWORK_KINDS = (("/company/", "company"), ("/in/", "profile"), ("/jobs/view/", "job"))
NETWORK_EMBEDDED = r"https://www\.linkedin\.com/(company/[^\"']+|in/[^\"']+|jobs/view/\d+)"
PRODUCT_EMBEDDED = r'"asin"\s*:\s*"([A-Z0-9]{10})"'
PRODUCT_PLACES = ("/dp/", "/gp/product/")


def _candidate(url: Column, kind: Column | str, identity: Column | None = None) -> Column:
    return F.struct(
        url.alias("url"), (F.lit(kind) if isinstance(kind, str) else kind).alias("resource_type"),
        (F.lit(None).cast("string") if identity is None else identity).alias("identity"),
    )


def _last_segment(url: Column) -> Column:
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


def _generic(base: Column, html: Column, hrefs: Column) -> Column:
    anchors = F.transform(hrefs, lambda h: F.struct(h.alias("href"), F.lit(None).cast("string").alias("text")))
    return F.transform(page_links(base, anchors), lambda x: _candidate(x["url"], "page"))


def _articles(base: Column, html: Column, hrefs: Column) -> Column:
    """Articles of the page's own host; names with a colon are other kinds of pages."""
    found = F.filter(hrefs, lambda h: h.startswith("/wiki/") & ~F.substr(h, F.lit(7)).contains(":"))
    titles = F.transform(found, lambda h: F.replace(F.substr(h, F.lit(7)), F.lit(" "), F.lit("_")))
    here = U.hostname(base) == "en.wikipedia.org"
    return F.when(here, F.transform(titles, lambda t: _candidate(F.concat(F.lit("https://en.wikipedia.org/wiki/"), t), "article", t)))


def _products(base: Column, html: Column, hrefs: Column) -> Column:
    leads = F.filter(hrefs, lambda h: h.contains(PRODUCT_PLACES[0]) | h.contains(PRODUCT_PLACES[1]))
    linked = F.transform(leads, lambda h: F.rtrim(F.substring_index(U.join(base, h), "?", 1), F.lit("/")))
    named = F.transform(F.regexp_extract_all(html, F.lit(PRODUCT_EMBEDDED), 1), lambda a: F.concat(F.lit("https://www.amazon.com/dp/"), a))
    return F.transform(F.concat(linked, named), lambda u: _candidate(u, "product", _last_segment(u)))


def _entities(base: Column, html: Column, hrefs: Column) -> Column:
    def kind_of(url: Column) -> Column:
        out = F.lit(None).cast("string")
        for part, kind in reversed(NETWORK_KINDS):
            out = F.when(url.contains(part), F.lit(kind)).otherwise(out)
        return out

    def tidy(url: Column, kind: Column) -> Column:
        bare = F.substring_index(url, "?", 1)
        return F.when(kind == "job", bare).otherwise(F.concat(F.rtrim(bare, F.lit("/")), F.lit("/")))

    full = F.transform(hrefs, lambda h: U.join(base, h))
    linked = F.transform(full, lambda u: let(kind_of(u), lambda k: _candidate(tidy(F.when(k == "job", u).otherwise(F.rtrim(u, F.lit("/"))), k), k)))
    embedded = F.transform(
        F.regexp_extract_all(html, F.lit(NETWORK_EMBEDDED), 1),
        lambda m: let(kind_of(F.concat(F.lit("/"), m)), lambda k: _candidate(tidy(F.concat(F.lit("https://www.linkedin.com/"), m), k), k)),
    )
    return F.filter(F.concat(linked, embedded), lambda c: c["resource_type"].isNotNull())


def _papers(base: Column, html: Column, hrefs: Column) -> Column:
    return F.transform(P.paper_links(html), lambda u: _candidate(u, "paper", _last_segment(u)))


def _chain(base: Column, html: Column, hrefs: Column) -> Column:
    found = F.filter(F.transform(P.chain_links(html), P.normalize_chain), lambda r: r["canonical_url"] != "")
    return F.transform(found, lambda r: _candidate(r["canonical_url"], r["entity_type"], F.try_element_at(F.map_values(r["identity"]), F.lit(1))))


RULES = {"generic": _generic, "wikipedia": _articles, "amazon": _products, "linkedin": _entities, "arxiv": _papers, "base": _chain}


def candidates(base: Column, html: Column, platform: Column) -> Column:
    """Where a page leads, by its platform's rule: ``array<struct<url, resource_type, identity>>``, each address once per
    type, first places first. Only the row's own rule is computed; unknown platforms follow the generic one."""
    empty = F.array().cast("array<struct<url:string,resource_type:string,identity:string>>")

    def routed(hrefs: Column) -> Column:
        out = _generic(base, html, hrefs)
        for name, rule in RULES.items():
            if name != "generic":
                out = F.when(platform == name, F.coalesce(rule(base, html, hrefs), empty)).otherwise(out)
        return first_occurrences(out, lambda c, _: F.concat_ws("\n", c["url"], c["resource_type"]))

    return let(H.anchor_targets(html), routed)


def _by_platform(values: dict, default) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("platform")), F.lit(default))


def edge_table(pages: DataFrame) -> DataFrame:
    """Pages (url, html, platform) as edges: platform, parent_url, position, canonical_url, resource_type, identity, score and
    discovery_mode. Of several rows of one url the first body by its text counts."""
    first = keep_first(pages.select("platform", F.col("url").alias("canonical_url"), "html"), KEY, ["html"])
    found = first.select("platform", F.col("canonical_url").alias("parent_url"), candidates(F.col("canonical_url"), F.coalesce("html", F.lit("")), F.col("platform")).alias("_c"))
    rows = explode_once(found, "_c", "position", "_to")
    return rows.select(
        "platform", "parent_url", "position", F.col("_to.url").alias("canonical_url"), F.col("_to.resource_type").alias("resource_type"),
        F.col("_to.identity").alias("identity"), _by_platform(SCORES, SCORES["generic"]).alias("score"), _by_platform(MODES, "page_links").alias("discovery_mode"),
    )


def traverse(seeds: DataFrame, pages: DataFrame, max_depth: int, visited: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, errors) of a walk from ``seeds`` (platform, canonical_url, resource_type, ord) over ``pages``.

    A record is a candidate with a page; it says how it was found (parent_url, seed_url, hop_depth, score, discovery_mode,
    identity). A candidate without a page is an error and can be tried again. An address found several times in one level
    counts where the order of discovery comes first; one seen in an earlier level, or among ``visited``, isn't taken again.
    """
    edges = cut_lineage(edge_table(pages).repartition("platform", "parent_url"))
    known = cut_lineage(pages.select("platform", F.col("url").alias("canonical_url")).distinct())
    none = F.lit(None).cast("string")
    level = keep_first(seeds, KEY, ["ord"]).select(
        *KEY, "resource_type", none.alias("identity"), F.lit(1.0).alias("score"), F.lit("direct_input").alias("discovery_mode"),
        none.alias("parent_url"), F.col("canonical_url").alias("seed_url"), F.lit(0).alias("hop_depth"), F.array(F.col("ord").cast("long")).alias("ord"),
    )
    if visited is not None:
        level = level.join(visited.select(*KEY).distinct(), KEY, "left_anti")
    level = cut_lineage(level)
    seen = level.select(*KEY) if visited is None else level.select(*KEY).unionByName(visited.select(*KEY))
    records, errors = [], []
    for depth in range(max_depth + 1):
        records.append(level.join(known, KEY, "left_semi").drop("ord"))
        errors.append(level.join(known, KEY, "left_anti").select(*KEY, "parent_url", "seed_url", "hop_depth", F.lit("DISCOVERY_CRAWL_FAILED").alias("error_code")))
        if depth == max_depth:
            break
        here = level.select("platform", F.col("canonical_url").alias("parent_url"), "seed_url", F.col("ord").alias("parent_ord"))
        found = edges.join(here, ["platform", "parent_url"]).withColumn("ord", F.concat("parent_ord", F.array(F.col("position").cast("long"))))
        fresh = keep_first(found.join(seen, KEY, "left_anti"), KEY, ["ord"])
        level = cut_lineage(fresh.select(
            *KEY, "resource_type", "identity", "score", "discovery_mode", "parent_url", "seed_url", F.lit(depth + 1).alias("hop_depth"), "ord"
        ))
        if level.isEmpty():
            break
        seen = seen.unionByName(level.select(*KEY))
    return reduce(DataFrame.unionByName, records), reduce(DataFrame.unionByName, errors)
