"""Addresses: keys, scope, joining, platform rules, links."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalogue import query, table
from pagemill.functions import html as H
from pagemill.functions import platform_urls as P
from pagemill.functions import policy
from pagemill.functions import text as T
from pagemill.functions import url as U
from pagemill.operators import links as L
from pagemill.operators.keyed import keep_first

# Platform addresses derived from every part row, the same way in SQL.
DERIVED_SQL = """
addresses AS (
  SELECT p_partkey, p_name, CASE p_partkey % 16
    WHEN 0 THEN 'https://www.linkedin.com/in/' || replace(p_name, ' ', '-') || '?trk=' || p_size
    WHEN 1 THEN 'linkedin.com/company/' || lower(p_type) || p_size
    WHEN 2 THEN 'https://cn.linkedin.com/jobs/view/' || (1000000 + p_partkey) || '/apply'
    WHEN 3 THEN 'https://www.linkedin.com/posts/' || replace(p_name, ' ', '_') || '_activity-' || (7000000 + p_partkey) || '-xyz'
    WHEN 4 THEN 'https://www.linkedin.com/feed/update/urn:li:activity:' || (9000000 + p_partkey)
    WHEN 5 THEN 'https://en.wikipedia.org/wiki/' || replace(p_name, ' ', '_')
    WHEN 6 THEN 'https://de.wikipedia.org/wiki/File:' || p_partkey
    WHEN 7 THEN 'https://arxiv.org/abs/' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') || '.' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') || 'v2'
    WHEN 8 THEN 'https://www.amazon.com/dp/B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '?tag=x'
    WHEN 9 THEN 'https://www.amazon.com/gp/product/b' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '/'
    WHEN 10 THEN 'https://basescan.org/address/0xab' || lpad(CAST(p_partkey AS VARCHAR), 38, '0')
    WHEN 11 THEN 'https://basescan.org/address/0xcd' || lpad(CAST(p_partkey AS VARCHAR), 38, '0') || '#code'
    WHEN 12 THEN 'https://basescan.org/tx/0x' || lpad(CAST(p_partkey AS VARCHAR), 64, 'f')
    WHEN 13 THEN 'https://basescan.org/token/0x' || lpad(CAST(p_partkey AS VARCHAR), 40, 'e')
    WHEN 14 THEN 'https://www.linkedin.com/company/' || lower(p_brand) || '/people/'
    ELSE 'http://shop.example.com/' || lower(p_type) || '/' || p_partkey || '?page=' || p_size || '#top' END AS url
  FROM part)
"""


def derived_addresses(spark, sf_dir):
    """The table of ``DERIVED_SQL``."""
    part = table(spark, sf_dir, "part")
    key, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    name, size = F.col("p_name"), F.col("p_size").cast("string")
    under = F.replace(name, F.lit(" "), F.lit("_"))
    kind = F.lower("p_type")

    def pad(width: int, fill: str = "0"):
        return F.lpad(text, width, fill)

    shapes = (
        ("https://www.linkedin.com/in/", F.replace(name, F.lit(" "), F.lit("-")), "?trk=", size),
        ("linkedin.com/company/", kind, size),
        ("https://cn.linkedin.com/jobs/view/", (key + 1000000).cast("string"), "/apply"),
        ("https://www.linkedin.com/posts/", under, "_activity-", (key + 7000000).cast("string"), "-xyz"),
        ("https://www.linkedin.com/feed/update/urn:li:activity:", (key + 9000000).cast("string")),
        ("https://en.wikipedia.org/wiki/", under),
        ("https://de.wikipedia.org/wiki/File:", text),
        ("https://arxiv.org/abs/", F.lpad((key % 10000).cast("string"), 4, "0"), ".", pad(5), "v2"),
        ("https://www.amazon.com/dp/B", pad(9), "?tag=x"),
        ("https://www.amazon.com/gp/product/b", pad(9), "/"),
        ("https://basescan.org/address/0xab", pad(38)),
        ("https://basescan.org/address/0xcd", pad(38), "#code"),
        ("https://basescan.org/tx/0x", pad(64, "f")),
        ("https://basescan.org/token/0x", pad(40, "e")),
        ("https://www.linkedin.com/company/", F.lower("p_brand"), "/people/"),
        ("http://shop.example.com/", kind, "/", text, "?page=", size, "#top"),
    )
    url = None
    for i, shape in enumerate(shapes):
        made = F.concat(*[F.lit(s) if isinstance(s, str) else s for s in shape])
        url = F.when(key % 16 == i, made) if url is None else url.when(key % 16 == i, made)
    return part.select("p_partkey", "p_name", url.alias("url"))


@query(
    """SELECT page_id, regexp_replace(url, '[?#].*$', '') AS canonical_url,
       regexp_replace(url, '#.*$', '') AS no_fragment,
       'generic:' || regexp_replace(url, '[?#].*$', '') AS url_key FROM pages"""
)
def url_canonical(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        U.without_query(url).alias("canonical_url"),
        U.without_fragment(url).alias("no_fragment"),
        U.url_key(F.lit("generic"), U.without_query(url)).alias("url_key"),
    )


@query(
    """SELECT page_id, split_part(split_part(url, '//', 2), '/', 1) AS scope_key,
       regexp_extract(url, '^([a-z]+):', 1) AS scheme,
       split_part(split_part(url, '//', 2), '/', 1) AS host,
       regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
       regexp_extract(url, '\\?([^#]*)', 1) AS query,
       regexp_extract(url, '#(.*)$', 1) AS fragment FROM pages"""
)
def url_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        U.scope_key(url).alias("scope_key"),
        U.scheme(url).alias("scheme"),
        U.hostname(url).alias("host"),
        U.path(url).alias("path"),
        U.query(url).alias("query"),
        U.fragment(url).alias("fragment"),
    )


@query(
    """SELECT page_id, substr(sha256('generic:' || regexp_replace(url, '[?#].*$', '')), 1, 16) AS doc_id
       FROM pages"""
)
def doc_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", T.doc_id(U.without_query(F.col("url")), F.lit("generic")).alias("doc_id")
    )


@query(
    """WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
       SELECT page_id, href,
         regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS joined FROM h"""
)
def url_join(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.explode(H.anchor_targets(F.col("html"))).alias("href")
    )
    return rows.select("page_id", "href", U.join(F.col("url"), F.col("href")).alias("joined"))


@query(
    """SELECT p_partkey, 'https://en.wikipedia.org/wiki/' || replace(p_name, ' ', '_') AS article_url,
       'https://www.amazon.com/s?k=' || replace(p_name, ' ', '%20') AS search_url,
       replace(replace(p_name || '~*(a/b)', ' ', '%20'), '/', '%2F') AS odd
       FROM (SELECT p_partkey, p_name FROM part)"""
)
def url_encode_values(spark, sf_dir):
    name = F.col("p_name")
    odd = U.percent_encode(F.concat(name, F.lit("~*(a/b)")), "*()")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(
            F.lit("https://en.wikipedia.org/wiki/"), U.percent_encode(F.replace(name, F.lit(" "), F.lit("_")), "_()")
        ).alias("article_url"),
        F.concat(F.lit("https://www.amazon.com/s?k="), U.percent_encode(name, "")).alias("search_url"),
        odd.alias("odd"),
    )


@query(
    f"""WITH {DERIVED_SQL}
    SELECT p_partkey, entity_type,
      CASE entity_type
        WHEN 'profile' THEN 'https://www.linkedin.com/in/' || v || '/'
        WHEN 'company' THEN 'https://www.linkedin.com/company/' || v || '/'
        WHEN 'job' THEN 'https://www.linkedin.com/jobs/view/' || v || '/'
        WHEN 'post' THEN 'https://www.linkedin.com/feed/update/urn:li:activity:' || v || '/'
        ELSE '' END AS canonical_url,
      CASE WHEN entity_type = 'unknown' THEN NULL ELSE v END AS identity,
      CASE WHEN p_partkey % 16 IN (0) THEN 'stripped_query'
           WHEN p_partkey % 16 = 3 THEN 'normalized_from_posts_path'
           WHEN p_partkey % 16 IN (1, 2, 4, 14) THEN ''
           ELSE 'not_linkedin_host' END AS notes
    FROM (SELECT *, CASE p_partkey % 16
        WHEN 0 THEN 'profile' WHEN 1 THEN 'company' WHEN 2 THEN 'job' WHEN 3 THEN 'post' WHEN 4 THEN 'post'
        WHEN 14 THEN 'company' ELSE 'unknown' END AS entity_type,
      CASE p_partkey % 16 WHEN 0 THEN regexp_extract(url, '/in/([^/?]+)', 1)
        WHEN 1 THEN regexp_extract(url, '/company/([^/?#]+)', 1)
        WHEN 14 THEN regexp_extract(url, '/company/([^/?#]+)', 1)
        WHEN 2 THEN regexp_extract(url, '/view/([0-9]+)', 1)
        WHEN 3 THEN regexp_extract(url, 'activity-([0-9]+)', 1)
        WHEN 4 THEN regexp_extract(url, 'activity:([0-9]+)', 1) END AS v FROM addresses)"""
)
def normalize_network_url(spark, sf_dir):
    found = P.normalize_network(F.col("url"))
    rows = derived_addresses(spark, sf_dir).select("p_partkey", found.alias("r"))
    return rows.select(
        "p_partkey",
        F.col("r.entity_type"),
        F.col("r.canonical_url"),
        F.try_element_at(F.map_values("r.identity"), F.lit(1)).alias("identity"),
        F.array_join("r.notes", ",").alias("notes"),
    )


@query(
    f"""WITH {DERIVED_SQL}
    SELECT p_partkey,
      CASE WHEN p_partkey % 16 IN (8, 9) THEN 'https://www.amazon.com/dp/B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') ELSE '' END AS product_url,
      CASE WHEN p_partkey % 16 = 5 THEN url ELSE '' END AS article_url,
      CASE WHEN p_partkey % 16 = 7 THEN left(url, length(url) - 2) ELSE '' END AS paper_url,
      CASE WHEN p_partkey % 16 = 11 THEN replace(url, '#code', '/#code') WHEN p_partkey % 16 IN (10, 12, 13) THEN url ELSE '' END AS chain_url,
      CASE p_partkey % 16 WHEN 10 THEN 'address' WHEN 11 THEN 'contract' WHEN 12 THEN 'transaction' WHEN 13 THEN 'token' ELSE 'unknown' END AS chain_type
    FROM addresses"""
)
def normalize_platform_urls(spark, sf_dir):
    url = F.col("url")
    return derived_addresses(spark, sf_dir).select(
        "p_partkey",
        P.normalize_product(url)["canonical_url"].alias("product_url"),
        P.normalize_article(url)["canonical_url"].alias("article_url"),
        P.normalize_paper(url)["canonical_url"].alias("paper_url"),
        P.normalize_chain(url)["canonical_url"].alias("chain_url"),
        P.normalize_chain(url)["entity_type"].alias("chain_type"),
    )


@query(
    f"""WITH {DERIVED_SQL}
    SELECT p_partkey, CASE WHEN p_partkey % 16 IN (0, 4, 14) THEN 'linkedin'
           WHEN p_partkey % 16 = 5 THEN 'wikipedia' WHEN p_partkey % 16 = 7 THEN 'arxiv'
           WHEN p_partkey % 16 = 8 THEN 'amazon' WHEN p_partkey % 16 IN (10, 11, 12, 13) THEN 'base'
           ELSE 'generic' END AS platform,
      CASE p_partkey % 16 WHEN 0 THEN 'profile' WHEN 4 THEN 'post' WHEN 5 THEN 'article' WHEN 7 THEN 'paper'
           WHEN 8 THEN 'product' WHEN 10 THEN 'address' WHEN 11 THEN 'address' WHEN 12 THEN 'transaction'
           WHEN 13 THEN 'token' WHEN 14 THEN 'company' ELSE 'page' END AS resource_type,
      CASE p_partkey % 16 WHEN 0 THEN regexp_extract(url, '/in/([^/?]+)', 1)
           WHEN 4 THEN regexp_extract(url, '/update/(.*)$', 1)
           WHEN 14 THEN regexp_extract(url, '/company/([^/?#]+)', 1) WHEN 5 THEN p_name
           WHEN 7 THEN regexp_extract(url, '/abs/(.*)$', 1) WHEN 8 THEN regexp_extract(url, '/dp/([^?]*)', 1)
           WHEN 10 THEN regexp_extract(url, '/address/([^#]*)', 1) WHEN 11 THEN regexp_extract(url, '/address/([^#]*)', 1)
           WHEN 12 THEN regexp_extract(url, '/tx/(.*)$', 1) WHEN 13 THEN regexp_extract(url, '/token/(.*)$', 1)
           ELSE url END AS value
    FROM addresses"""
)
def url_platform_infer(spark, sf_dir):
    rows = derived_addresses(spark, sf_dir).select("p_partkey", P.infer_task(F.col("url")).alias("r"))
    return rows.select("p_partkey", "r.platform", "r.resource_type", "r.value")


@query(
    f"""WITH {DERIVED_SQL}, b AS (
    SELECT CASE p_partkey % 16 WHEN 0 THEN 'profile' WHEN 2 THEN 'job' WHEN 3 THEN 'post' WHEN 4 THEN 'post'
        WHEN 14 THEN 'company' ELSE 'other' END AS bucket,
      regexp_replace(url, '#.*$', '') AS url FROM addresses)
    SELECT bucket, count(DISTINCT url) AS n, min(url) AS first_url, max(url) AS last_url FROM b GROUP BY 1"""
)
def bucket_urls(spark, sf_dir):
    rows = L.bucket_links(derived_addresses(spark, sf_dir), "url")
    return rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("url").alias("first_url"), F.max("url").alias("last_url")
    )


@query(
    """WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
       SELECT page_id, count(*) AS n_anchors, count(DISTINCT href) AS n_distinct, min(href) AS first_href,
              CAST(sum(length(href)) AS BIGINT) AS href_chars FROM a GROUP BY page_id"""
)
def anchors(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(H.anchor_targets(F.col("html"))).alias("href"))
    return rows.groupBy("page_id").agg(
        F.count("*").alias("n_anchors"),
        F.count_distinct("href").alias("n_distinct"),
        F.min("href").alias("first_href"),
        F.sum(F.length("href")).alias("href_chars"),
    )


LINKS_SQL = """
a AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages),
u AS (SELECT page_id, url, unnest(hs) AS href, unnest(range(len(hs))) AS pos FROM a),
j AS (SELECT page_id, url, regexp_replace(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href, '[?#].*$', '') AS link, pos FROM u),
d AS (SELECT page_id, url, link, min(pos) AS pos FROM j GROUP BY ALL),
links AS (SELECT page_id, url, link, row_number() OVER (PARTITION BY page_id ORDER BY pos)::INTEGER - 1 AS position FROM d)
"""


@query(f"WITH {LINKS_SQL} SELECT page_id, url AS parent_url, link AS canonical_url, position FROM links")
def links_same_host(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = L.page_links(F.col("url"), L.bare_anchors(F.col("html")))
    return L.explode_links(pages, found).select("page_id", "parent_url", "canonical_url", "position")


@query(
    """SELECT page_id, CAST(i AS INT) AS position, 'http://q.example.com/' || page_id || ['/a', '/b', '/c', '/d'][i + 1] AS canonical_url
         FROM pages, range(4) r(i)"""
)
def links_any_quoting(spark, sf_dir):
    """Double, single and no quotes, references, upper case, and links in comments, which don't count."""
    at = F.concat(F.lit("/"), F.col("page_id").cast("string"))
    html = F.concat(
        F.lit('<p><a href="'), at, F.lit("/a\">x</a><!-- <a href='"), at, F.lit("/hidden'>no</a> --><A class=k HREF='"), at,
        F.lit("/b?x=1&amp;y=2'>y</A><a href="), at, F.lit("/c>z</a><a\nhref = \""), at, F.lit('/d#part">w</a></p>'),
    )
    base = F.concat(F.lit("http://q.example.com"), at, F.lit("/"))
    pages = table(spark, sf_dir, "pages").select("page_id", base.alias("url"), html.alias("html"))
    found = L.page_links(F.col("url"), L.bare_anchors(F.col("html")))
    return L.explode_links(pages, found).select("page_id", "position", "canonical_url")


@query(
    """SELECT page_id, CAST(i AS INT) AS position, 'http://w.example.com/' || page_id || ['/one', '/two&x', '/école', '/é', '/last'][i + 1] AS canonical_url,
         ['1 > 0', 'two words', 'É & E', '', 'end'][i + 1] AS anchor_text FROM pages, range(5) r(i)"""
)
def links_whole_markup(spark, sf_dir):
    """Signs inside quoted values, links in scripts and styles (no links), references of every kind, and the links' texts."""
    at = F.concat(F.lit("/"), F.col("page_id").cast("string"))
    parts = (
        '<p><a title="x>y" data-k=\'"\' href="', at, '/one">1 &gt; 0</a><script>var s=\'<a href="/three">no</a>\';</script><style>a{b:"<a href=/s>"}</style>',
        "<a href='", at, "/two&#x26;x'>two\n <b>words</b> </a><a id=1 href=", at, "/&eacute;cole>&Eacute; &amp; E<br></a><A HREF=\"", at,
        '/&#233;"><img alt="i"></A><abbr href="/no">n</abbr><a href="', at, '/last">end',
    )
    html = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("http://w.example.com"), at, F.lit("/")).alias("url"), html.alias("html"))
    found = L.page_links(F.col("url"), L.bare_anchors(F.col("html")))
    return L.explode_links(pages, found).select("page_id", "position", "canonical_url", "anchor_text")


@query(f"WITH {LINKS_SQL} SELECT page_id, link AS canonical_url FROM links WHERE position < 3")
def links_limit(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = L.page_links(F.col("url"), L.bare_anchors(F.col("html")), limit=3)
    return L.explode_links(pages, found).select("page_id", "canonical_url")


@query(
    f"""WITH {LINKS_SQL}, n AS (SELECT page_id, count(*) AS n FROM links GROUP BY page_id)
    SELECT split_part(split_part(url, '//', 2), '/', 1) AS host, count(*) AS pages, CAST(sum(coalesce(n, 0)) AS BIGINT) AS links,
      round(sum(coalesce(n, 0)) * 1000.0 / sum(length(html)), 6) AS links_per_1000_chars
    FROM pages LEFT JOIN n USING (page_id) GROUP BY 1"""
)
def link_density_by_host(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = F.size(L.page_links(F.col("url"), L.bare_anchors(F.col("html"))))
    rows = pages.select(U.hostname(F.col("url")).alias("host"), found.alias("n"), F.length("html").alias("chars"))
    return rows.groupBy("host").agg(
        F.count("*").alias("pages"),
        F.sum("n").alias("links"),
        F.round(F.sum("n") * F.lit(1000.0) / F.sum("chars"), 6).alias("links_per_1000_chars"),
    )


@query(
    """SELECT page_id, url, canonical_url FROM (
         SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS canonical_url,
           row_number() OVER (PARTITION BY regexp_replace(url, '[?#].*$', '') ORDER BY page_id) AS rn FROM pages)
       WHERE rn = 1"""
)
def page_dedup_keep_first(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", U.without_query(F.col("url")).alias("canonical_url"))
    return keep_first(pages, ["canonical_url"], ["page_id"])


@query(
    f"""WITH {DERIVED_SQL}
    SELECT p_partkey, 'https://' || lower(p_brand) || '.example.com/' AS seed_url,
      regexp_replace(list_extract(string_split(rtrim(url, '/'), '/'), -1), '[^\\pL\\pN\\-_.]', '_', 'g') AS slug
    FROM addresses JOIN (SELECT p_partkey AS k, p_brand FROM part) ON k = p_partkey"""
)
def seed_and_slug(spark, sf_dir):
    rows = derived_addresses(spark, sf_dir).join(
        table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey"
    )
    domain = F.concat(F.lit(" "), F.lower("p_brand"), F.lit(".example.com/ "))
    return rows.select(
        "p_partkey", U.seed_address(domain).alias("seed_url"), T.slug(F.col("url"), F.col("p_partkey")).alias("slug")
    )


@query(
    """WITH t AS (SELECT page_id, '<a href="https://www.amazon.com/dp/B' || lpad(CAST(page_id AS VARCHAR), 9, '0')
          || '"></a><li data-asin="C' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '"></li>' || html AS html FROM pages)
       SELECT page_id, 'https://www.amazon.com/dp/C' || lpad(CAST(page_id AS VARCHAR), 9, '0') AS related,
         CAST(2 AS BIGINT) AS n_ids FROM t"""
)
def related_products(spark, sf_dir):
    number = F.lpad(F.col("page_id").cast("string"), 9, "0")
    html = F.concat(
        F.lit('<a href="https://www.amazon.com/dp/B'), number, F.lit('"></a><li data-asin="C'), number,
        F.lit('"></li>'), F.col("html"),
    )
    own = F.concat(F.lit("b"), number)
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        F.array_join(P.related_products(html, own), ",").alias("related"),
        F.size(P.product_ids(html)).cast("bigint").alias("n_ids"),
    )


@query(
    f"""WITH {DERIVED_SQL}
    SELECT p_partkey, CASE WHEN p_partkey % 16 IN (0, 4, 14) THEN 'linkedin' WHEN p_partkey % 16 = 5 THEN 'wikipedia' WHEN p_partkey % 16 = 7 THEN 'arxiv'
        WHEN p_partkey % 16 = 8 THEN 'amazon' WHEN p_partkey % 16 IN (10, 11, 12, 13) THEN 'base' ELSE 'generic' END AS platform,
      CASE p_partkey % 16 WHEN 0 THEN CASE WHEN p_partkey % 32 = 0 THEN 'api,playwright,camoufox' ELSE 'playwright,camoufox' END
        WHEN 4 THEN 'camoufox,playwright'
        WHEN 14 THEN CASE WHEN p_partkey % 32 = 0 THEN 'api,playwright,camoufox' ELSE 'playwright,camoufox' END
        WHEN 5 THEN 'api,http,playwright' WHEN 7 THEN 'api,http,playwright'
        WHEN 10 THEN 'api,http,playwright' WHEN 11 THEN 'api,http,playwright' WHEN 12 THEN 'api,http,playwright'
        WHEN 13 THEN 'api,http,playwright' ELSE 'http,playwright,camoufox' END AS chain,
      CASE p_partkey % 16 WHEN 0 THEN 'camoufox' WHEN 4 THEN NULL
        WHEN 5 THEN NULL WHEN 7 THEN NULL
        WHEN 10 THEN NULL WHEN 11 THEN NULL WHEN 12 THEN NULL WHEN 13 THEN NULL ELSE 'camoufox' END AS after_playwright
    FROM addresses"""
)
def backend_route(spark, sf_dir):
    rows = derived_addresses(spark, sf_dir).select("p_partkey", P.infer_task(F.col("url")).alias("r"))
    chain = policy.route(F.col("r.platform"), F.col("r.resource_type"), F.col("p_partkey") % 32 == 0)
    rows = rows.withColumn("c", chain)
    return rows.select(
        "p_partkey",
        "r.platform",
        F.array_join("c", ",").alias("chain"),
        policy.escalate(F.col("c"), F.lit("playwright")).alias("after_playwright"),
    )


@query(
    """SELECT page_id, 'https://en.wikipedia.org/wiki/Art_' || page_id AS articles,
         'https://arxiv.org/abs/2101.' || lpad(CAST(page_id AS VARCHAR), 5, '0') AS papers,
         'https://basescan.org/address/0xcd/#code https://basescan.org/tx/0xab' || page_id AS chain,
         'https://www.amazon.com/dp/B' || lpad(CAST(page_id AS VARCHAR), 9, '0') AS products,
         'https://www.linkedin.com/in/p' || page_id || '/ https://www.linkedin.com/company/c' || page_id || '/' AS people FROM pages"""
)
def platform_links(spark, sf_dir):
    number = F.col("page_id").cast("string")
    parts = (
        '<a href="/wiki/Art_', number, '">x</a><a href="/wiki/File:', number, '"></a> https://arxiv.org/abs/2101.',
        F.lpad(number, 5, "0"), "v2 /abs/2101.", F.lpad(number, 5, "0"), " https://basescan.org/tx/0xab", number,
        ' https://basescan.org/address/0xcd/#code <i data-asin="b', F.lpad(number, 9, "0"), '"></i><a href="/in/p', number,
        '?x=1#y">me</a><a href="#z"></a><a href="/feed/">f</a><code>"https://www.linkedin.com/company/c', number, '."</code>',
    )
    html = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.col("html"))
    rows = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    rows = rows.withColumn("anchors", L.bare_anchors(F.col("html")))
    names = {"articles": "wikipedia", "papers": "arxiv", "chain": "base", "products": "amazon", "people": "linkedin"}
    return rows.select(
        "page_id",
        *[
            F.array_join(L.platform_links(p, F.col("html"), F.col("anchors"), F.lit("https://x.example/")), " ").alias(n)
            for n, p in names.items()
        ],
    )
