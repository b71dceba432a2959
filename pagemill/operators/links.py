"""Link extraction and candidates, per page and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.html import bare_anchors  # noqa: F401
from pagemill.functions import platform_urls as P
from pagemill.functions import url as U
from pagemill.functions.arrays import first_occurrences, let
from pagemill.operators.chunk import explode_once

# Candidate score per platform.
SCORES = {"generic": 0.3, "wikipedia": 0.8, "amazon": 0.7, "linkedin": 0.85, "arxiv": 0.7, "base": 0.6}


def page_links(
    base: Column,
    anchors: Column,
    limit: int | None = None,
    include_subdomains: bool = False,
    allow_external: bool = False,
    ignore_query: bool = True,
    include_paths: str | None = None,
    exclude_paths: str | None = None,
) -> Column:
    """Anchors ``array<struct<href, text>>`` as distinct absolute links, first anchor wins; all of them unless limited."""
    return let(
        F.struct(base.alias("url"), U.hostname(base).alias("host")),
        lambda b: _links_from(
            b["url"], b["host"], anchors, limit, include_subdomains, allow_external, ignore_query, include_paths, exclude_paths
        ),
    )


def _links_from(
    base, host, anchors, limit, include_subdomains, allow_external, ignore_query, include_paths, exclude_paths
) -> Column:
    full = F.transform(anchors, lambda a: F.struct(U.join(base, a["href"]).alias("url"), a["text"].alias("text")))

    def wanted(link: Column) -> Column:
        test = U.scheme(link["url"]).isin("http", "https")
        if not allow_external:
            own = U.hostname(link["url"])
            same = (own == host) & (host != "")
            if include_subdomains:
                same = same | ((host != "") & own.endswith(F.concat(F.lit("."), host)))
            test = test & same
        if include_paths:
            test = test & U.path(link["url"]).rlike(include_paths)
        if exclude_paths:
            test = test & ~U.path(link["url"]).rlike(exclude_paths)
        return test

    kept = F.filter(full, wanted)
    if ignore_query:
        kept = F.transform(kept, lambda k: F.struct(U.without_query(k["url"]).alias("url"), k["text"].alias("text")))
    found = first_occurrences(kept, lambda k, _: k["url"])
    return found if limit is None else F.slice(found, 1, max(limit, 0))


def explode_links(pages: DataFrame, links: Column, url: str = "url") -> DataFrame:
    """Link candidates: one row per link with its parent, position and score."""
    rows = explode_once(pages.withColumn("_links", links), "_links", "position", "_link")
    return rows.withColumns(
        {
            "canonical_url": F.col("_link.url"),
            "anchor_text": F.col("_link.text"),
            "parent_url": F.col(url),
            "discovery_mode": F.lit("page_links"),
            "score": F.lit(SCORES["generic"]),
        }
    ).drop("_link")


def platform_links(platform: str, html: Column, anchors: Column, own_url: Column) -> Column:
    """Canonical entity addresses a page of one platform leads to."""
    hrefs = F.transform(anchors, lambda a: a["href"])
    if platform == "arxiv":
        return P.paper_links(html)
    if platform == "base":
        found = F.transform(P.chain_links(html), P.normalize_chain)
        return _canonical(found)
    if platform == "amazon":
        return P.related_products(html, P.product_id(own_url))
    if platform == "wikipedia":
        articles = F.filter(hrefs, lambda h: h.startswith("/wiki/") & ~F.substring(h, 7, 2147483647).contains(":"))
        return F.array_distinct(
            F.transform(
                articles,
                lambda h: F.concat(
                    F.lit("https://en.wikipedia.org/wiki/"), F.replace(F.substring(h, 7, 2147483647), F.lit(" "), F.lit("_"))
                ),
            )
        )
    if platform == "linkedin":
        base = F.lit("https://www.linkedin.com/")
        usable = F.filter(hrefs, lambda h: ~h.startswith("#") & ~F.lower(h).startswith("javascript:"))
        full = F.transform(usable, lambda h: F.when(h.startswith("/"), U.join(base, h)).otherwise(h))
        own = F.filter(full, lambda u: F.lower(u).contains("linkedin.com") & U.has_web_scheme(u))
        found = P.network_links(html, F.transform(own, U.without_fragment))
        return _canonical(F.transform(F.filter(found, lambda u: ~P.is_network_nav(u)), P.normalize_network))
    raise ValueError(f"no link rule for platform {platform!r}")


def _canonical(found: Column) -> Column:
    known = F.filter(found, lambda r: r["entity_type"] != "unknown")
    return F.array_distinct(F.transform(known, lambda r: r["canonical_url"]))


def bucket_links(df: DataFrame, url: str, own_vanity: Column | None = None) -> DataFrame:
    """Distinct addresses with their bucket, the profile bucket split into self and others."""
    clean = df.withColumn("_url", F.trim(U.without_fragment(F.col(url)))).filter(F.col("_url") != "")
    bucket = P.network_bucket(F.col("_url"))
    if own_vanity is not None:
        vanity = F.lower(F.try_element_at(P.normalize_network(F.col("_url"))["identity"], F.lit("vanity")))
        mine = F.when(vanity == F.lower(own_vanity), F.lit("profiles_self")).otherwise(F.lit("profiles_others"))
        bucket = F.when(bucket == "profile", mine).otherwise(bucket)
    return clean.select(bucket.alias("bucket"), F.col("_url").alias("url")).distinct()
