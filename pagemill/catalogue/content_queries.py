"""Pages: problems, metadata, main text, sections, chunks, schema fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalogue import query, table
from pagemill.catalogue.text_queries import noise_sql
from pagemill.functions import html as H
from pagemill.functions import page_fields as P
from pagemill.functions import policy
from pagemill.operators import content as K
from pagemill.operators.chunk import explode_once
from pagemill.session import spread


def pages_of(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def unescape_sql(text: str) -> str:
    """Character references of the pages; the closing semicolon may be cut off."""
    out = text
    for entity, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        out = f"regexp_replace({out}, '&{entity};?', '{char}', 'g')"
    return out


ARTICLE = f"""parts AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages),
  blocks AS (SELECT page_id, unnest(string_split(replace(body, '<p>', chr(1)), chr(1))) AS block,
    unnest(range(len(string_split(replace(body, '<p>', chr(1)), chr(1))))) AS b FROM parts),
  strings AS (SELECT page_id, b, unnest(regexp_split_to_array(block, '<[^>]*>')) AS s,
    unnest(range(len(regexp_split_to_array(block, '<[^>]*>')))) AS i FROM blocks),
  kept AS (SELECT page_id, b, i, trim({unescape_sql('s')}) AS s FROM strings WHERE trim({unescape_sql('s')}) <> '')"""


@query(
    """SELECT page_id, CASE page_id % 5 WHEN 1 THEN 'CONTENT_EMPTY' WHEN 2 THEN 'AUTH_EXPIRED' WHEN 3 THEN 'CAPTCHA'
         WHEN 4 THEN 'AUTH_EXPIRED' END AS error_code,
       CASE page_id % 5 WHEN 1 THEN 'retry with browser' WHEN 2 THEN 'refresh login session and retry'
         WHEN 3 THEN 'complete login in auto-browser and retry' WHEN 4 THEN 'refresh login session and retry' END AS next_action,
       CASE WHEN page_id % 5 = 3 THEN false WHEN page_id % 5 > 0 THEN true END AS retryable,
       page_id % 5 <> 1 AS has_heading FROM pages"""
)
def content_class(spark, sf_dir):
    key = F.col("page_id") % 5
    html = (
        F.when(key == 1, F.left("html", F.lit(120)))
        .when(key == 2, F.concat(F.lit("<!-- AuthWall -->"), "html"))
        .when(key == 3, F.concat(F.lit("<p>Solve this CAPTCHA</p>"), "html"))
        .otherwise(F.col("html"))
    )
    url = F.when(key == 4, F.concat(F.col("url"), F.lit("/login"))).otherwise(F.col("url"))
    rows = table(spark, sf_dir, "pages").select("page_id", html.alias("html"), url.alias("url"))
    error = policy.classify_content(F.col("html"), F.col("url"))
    return rows.withColumn("e", error).select(
        "page_id", "e.error_code", policy.next_action(F.col("e.agent_hint")).alias("next_action"), "e.retryable",
        H.has_heading(F.col("html")).alias("has_heading"),
    )


@query(
    f"""SELECT page_id, trim({unescape_sql("regexp_extract(html, '<title>([^<]*)</title>', 1)")}) AS title, url AS canonical_url,
        'html_meta:title' AS title_source FROM pages"""
)
def page_title(spark, sf_dir):
    rows = pages_of(spark, sf_dir).select("page_id", "url", H.shred("html", F.lit("generic")).alias("nodes"))
    meta = rows.select("page_id", P.page_meta(F.col("nodes"), F.col("url")).alias("m"))
    return meta.select(
        "page_id", "m.title", "m.canonical_url", F.try_element_at("m.field_sources", F.lit("title")).alias("title_source")
    )


@query(
    """SELECT page_id, 'OG ' || page_id AS title, 'html_meta:og:title' AS title_source,
         'About "' || page_id || '"' AS description,
         regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/canon/' || page_id AS canonical_url,
         'article' AS og_type, 'https://img.example.org/' || page_id || '.png' AS image_url FROM pages"""
)
def page_meta(spark, sf_dir):
    number = F.col("page_id").cast("string")
    head = F.concat(
        F.lit('<html><head><meta property="og:title" content="OG '), number,
        F.lit('"><meta name="description" content="About &quot;'), number,
        F.lit('&quot;"><link rel="canonical" href="/canon/'), number,
        F.lit('"><meta property="og:type" content="article"/><meta property="og:image" content="https://img.example.org/'),
        number, F.lit('.png">'), F.col("html"),
    )
    rows = pages_of(spark, sf_dir).select("page_id", "url", H.shred(head, F.lit("generic")).alias("nodes"))
    meta = rows.select("page_id", P.page_meta(F.col("nodes"), F.col("url")).alias("m"))
    return meta.select(
        "page_id", "m.title", F.try_element_at("m.field_sources", F.lit("title")).alias("title_source"), "m.description",
        "m.canonical_url", "m.og_type", "m.image_url",
    )


@query(
    f"""WITH {ARTICLE} SELECT page_id, string_agg(s, chr(10) ORDER BY b, i) AS plain_text, 5 AS noise_removed,
        CASE WHEN sum(length(s)) > 50 THEN 'fallback:semantic:article' ELSE 'fallback:fallback:body' END AS selector_used
        FROM kept GROUP BY page_id"""
)
def html_text(spark, sf_dir):
    rows = K.extract_pages(pages_of(spark, sf_dir), reduce=False)
    return rows.select("page_id", "plain_text", "noise_removed", "selector_used")


@query(
    """SELECT page_id, CAST(length('w' || page_id) * 20000 + 19999 AS BIGINT) AS chars,
         md5(rtrim(repeat('w' || page_id || ' ', 20000))) AS body_md5 FROM pages"""
)
def long_pages(spark, sf_dir):
    """Pages of over 40,000 characters without an article, up to several times that."""
    body = F.rtrim(F.repeat(F.concat(F.lit("w"), F.col("page_id").cast("string"), F.lit(" ")), F.lit(20000)))
    html = F.concat(F.lit("<html><body><div><p>"), body, F.lit("</p></div><p>x</p></body></html>"))
    pages = pages_of(spark, sf_dir).select("page_id", "url", html.alias("html"))
    found = K.extract_pages(pages, reduce=False)
    return found.select("page_id", F.length("plain_text").cast("bigint").alias("chars"), F.md5("plain_text").alias("body_md5"))


@query(
    f"""WITH {ARTICLE}, p AS (SELECT page_id, b, lower(string_agg(s, ' ' ORDER BY i)) AS k FROM kept GROUP BY page_id, b),
        firsts AS (SELECT page_id, b, b = 0 OR (NOT {noise_sql('k')} AND (length(k) < 24
          OR row_number() OVER (PARTITION BY page_id, b = 0, k ORDER BY b) = 1)) AS ok FROM p)
        SELECT page_id, max(s) FILTER (WHERE b = 0) AS heading_text, 1 AS heading_level,
          string_agg(s, chr(10) ORDER BY b, i) FILTER (WHERE b > 0 AND ok) AS text,
          '# ' || max(s) FILTER (WHERE b = 0) AS markdown_head
        FROM kept JOIN firsts USING (page_id, b) GROUP BY page_id"""
)
def html_sections(spark, sf_dir):
    rows = K.extract_pages(pages_of(spark, sf_dir)).select("page_id", "sections")
    parts = explode_once(rows, "sections", "pos", "s")
    return parts.select(
        "page_id", "s.heading_text", "s.heading_level", "s.text",
        F.substring_index("s.markdown", "\n", 1).alias("markdown_head"),
    )


@query()
def html_chunks(spark, sf_dir):
    rows = K.extract_pages(pages_of(spark, sf_dir)).select("doc_id", "page_id", "sections")
    chunks = K.page_chunks(rows)
    return chunks.select(
        "page_id", "chunk_id", "chunk_index", "text", F.array_join("section_path", " > ").alias("section_path"),
        "heading_level", "char_offset_start", "char_offset_end", "source_element", "token_count_estimate",
    )


@query(
    f"""WITH {ARTICLE} SELECT page_id, trim({unescape_sql("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}) AS heading,
        (SELECT string_agg(s, ' ' ORDER BY b, i) FROM kept k WHERE k.page_id = pages.page_id AND b > 0 AND b <= 1) AS lead,
        regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || list_extract(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS first_link,
        len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_links,
        'css:nav a@href' AS link_source FROM pages"""
)
def css_fields(spark, sf_dir):
    schema = {
        "title": {"selector": "article h1"},
        "fields": {
            "lead": {"selector": "article p"},
            "first_link": {"selector": "nav a", "attribute": "href"},
            "links": {"selector": "nav li a[href], aside a", "attribute": "href", "multiple": True},
        },
    }
    rows = pages_of(spark, sf_dir).select("page_id", "url", H.shred("html", F.lit("generic")).alias("nodes"))
    rows = rows.withColumn("f", P.css_fields(F.col("nodes"), schema, F.col("url")))

    def one(name: str):
        return F.try_element_at(F.try_element_at("f", F.lit(name)), F.lit(1))

    return rows.select(
        "page_id", one("title").alias("heading"), one("lead").alias("lead"), one("first_link").alias("first_link"),
        F.size(F.try_element_at("f", F.lit("links"))).cast("bigint").alias("n_links"),
        F.try_element_at(P.css_sources(schema, F.col("f")), F.lit("first_link")).alias("link_source"),
    )


@query(
    """SELECT p_partkey, p_name AS title, p_brand AS brand, '$' || p_size || '.99' AS price, 'In Stock' AS availability,
         p_type || '|' || p_brand AS category, 'first ' || p_name || '|second' AS bullets, 'B0' || p_partkey || '=' || p_type AS variants,
         'No customer reviews yet' AS rating, '0 reviews' AS reviews_count,
         'https://shop.example.com/img/' || p_partkey || '.png' AS images FROM part"""
)
def product_page(spark, sf_dir):
    number, name, brand = F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_brand")
    html = F.concat(
        F.lit('<body><h1 id="productTitle"> '), name, F.lit(' </h1><a id="bylineInfo" href="/stores">Visit the '), brand,
        F.lit(' Store</a><div class="a-price"><span class="a-offscreen">$'), F.col("p_size").cast("string"),
        F.lit('.99</span></div><div id="availability"><span class="a-color-success"> In Stock </span></div>'
              '<div id="wayfinding-breadcrumbs_feature_div"><a href="#">'), F.col("p_type"), F.lit('</a><a href="#">'), brand,
        F.lit('</a></div><ul id="feature-bullets"><li><span class="a-list-item">first '), name,
        F.lit('</span><li><span class="a-list-item">second</span></ul><ul id="twister"><li data-asin="B0'), number,
        F.lit('" title="'), F.col("p_type"), F.lit('"></ul><p>No customer reviews yet</p><div id="altImages"><img src="/img/'),
        number, F.lit('.png"><img src="/img/'), number, F.lit('.png"></div></body>'),
    )
    rows = spread(table(spark, sf_dir, "part")).select("p_partkey", H.shred(html, F.lit("amazon")).alias("nodes"))
    url = F.lit("https://shop.example.com/dp/x")
    rows = rows.select(
        "p_partkey", P.product_fields(F.col("nodes"), url).alias("f"), P.product_variants(F.col("nodes")).alias("v")
    )
    pairs = F.transform("v", lambda v: F.concat(v["asin"], F.lit("="), v["label"]))
    return rows.select(
        "p_partkey", "f.title", "f.brand", "f.price", "f.availability", F.array_join("f.category", "|").alias("category"),
        F.array_join("f.bullet_points", "|").alias("bullets"), F.array_join(pairs, "|").alias("variants"), "f.rating",
        "f.reviews_count", F.array_join("f.images", "|").alias("images"),
    )


@query(
    """SELECT s_suppkey, s_name AS title, s_name AS seller_name, '4.5 out of 5' AS seller_rating,
         'Since ' || s_nationkey AS seller_since, 'A' || s_suppkey || ':Item ' || s_suppkey || ':https://shop.example.com/dp/'
         || s_suppkey || ':$' || s_nationkey AS listings FROM supplier"""
)
def seller_page(spark, sf_dir):
    number, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    html = F.concat(
        F.lit('<body><div id="seller-profile-container"><h1>'), F.col("s_name"),
        F.lit('</h1></div><b class="seller-rating">4.5 out of 5</b><i id="seller-since">Since '), nation,
        F.lit('</i><div class="seller-product" data-asin="A'), number, F.lit('"><a href="/dp/'), number, F.lit('">Item '),
        number, F.lit('</a><span class="seller-product-price">$'), nation, F.lit("</span></div></body>"),
    )
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", H.shred(html, F.lit("amazon")).alias("nodes"))
    rows = rows.select("s_suppkey", P.seller_fields(F.col("nodes"), F.lit("https://shop.example.com/sp")).alias("f"))
    cards = F.transform("f.product_listings", lambda c: F.concat_ws(":", c["asin"], c["title"], c["url"], c["price"]))
    return rows.select(
        "s_suppkey", "f.title", "f.seller_name", "f.seller_rating", "f.seller_since", F.array_join(cards, "|").alias("listings")
    )


@query(
    """SELECT c_custkey, 'Token ' || c_custkey AS title, 'USD' AS price_currency, CAST(c_custkey AS VARCHAR) || '.5' AS price_usd,
         c_mktsegment AS token_reputation, CAST(c_nationkey AS VARCHAR) AS holders, 'contract C {' || chr(10) || '}' AS source_code
       FROM customer"""
)
def explorer_page(spark, sf_dir):
    number = F.col("c_custkey").cast("string")
    html = F.concat(
        F.lit('<head><meta name="description" content="Token Rep: '), F.col("c_mktsegment"), F.lit(" | Price: $9 | Holders: "),
        F.col("c_nationkey").cast("string"), F.lit(' | x"><script type="application/ld+json">{"@type":"Product","name":"Token '),
        number, F.lit('","offers":{"price":"'), number,
        F.lit('.5","priceCurrency":"USD"}}</script></head><main><h1>Old</h1><pre>contract C {\n<b>}</b></pre></main>'),
    )
    rows = spread(table(spark, sf_dir, "customer")).select("c_custkey", H.shred(html, F.lit("base")).alias("nodes"))
    rows = rows.select("c_custkey", P.explorer_fields(F.col("nodes"), F.lit("contract")).alias("f"))
    return rows.select(
        "c_custkey", "f.title", "f.price_currency", "f.price_usd", "f.token_reputation", "f.holders", "f.source_code"
    )


@query(
    """SELECT c_custkey, 'https://www.linkedin.com/company/c' || c_custkey || '/' || '|company|Firm ' || c_custkey || ';'
         || 'https://www.linkedin.com/in/p' || c_nationkey || '/' || '|person|' || c_name AS results FROM customer"""
)
def search_results(spark, sf_dir):
    number, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    html = F.concat(
        F.lit('<main><a href="/company/c'), number, F.lit('?trk=1"><span>Firm</span> '), number,
        F.lit('</a><a href="https://www.linkedin.com/in/p'), nation, F.lit('/">'), F.col("c_name"), F.lit('</a><a href="/in/p'),
        nation, F.lit('">again</a><a href="/help/">Help</a><a href="/company/c'), number, F.lit('"></a></main>'),
    )
    rows = spread(table(spark, sf_dir, "customer")).select("c_custkey", H.shred(html, F.lit("linkedin")).alias("nodes"))
    rows = rows.select("c_custkey", P.search_results(F.col("nodes")).alias("r"))
    shown = F.transform("r", lambda r: F.concat_ws("|", r["canonical_url"], r["entity_type"], r["title"]))
    return rows.select("c_custkey", F.array_join(shown, ";").alias("results"))


@query(
    """WITH RECURSIVE x AS (SELECT doc_id, str_split(coalesce(text, ''), chr(10)) AS a FROM documents),
         l AS MATERIALIZED (SELECT doc_id, i, 1 + (i * i + doc_id) % 4 AS lv, i || ' ' || md5(a[i + 1]) AS body, len(a) AS n FROM (SELECT doc_id, a, unnest(range(0, len(a))) AS i FROM x)),
         up AS MATERIALIZED (SELECT a.doc_id, a.i, max(b.i) FILTER (b.i < a.i AND b.lv < a.lv) AS parent, coalesce(min(b.i) FILTER (b.i > a.i AND b.lv <= a.lv), any_value(a.n)) AS stop
           FROM l a JOIN l b USING (doc_id) GROUP BY a.doc_id, a.i),
         path(doc_id, i, spot, names) AS (SELECT doc_id, i, i, 'S ' || i FROM up
           UNION ALL SELECT path.doc_id, path.i, up.parent, 'S ' || up.parent || ' > ' || names FROM path JOIN up ON up.doc_id = path.doc_id AND up.i = path.spot WHERE up.parent IS NOT NULL),
         whole AS (SELECT doc_id, i, arg_min(names, spot) AS section_path FROM path GROUP BY doc_id, i),
         texts AS (SELECT up.doc_id, up.i, string_agg(CASE WHEN l.i = up.i THEN body ELSE 'S ' || l.i || chr(10) || body END, chr(10) ORDER BY l.i) AS text FROM up JOIN l ON l.doc_id = up.doc_id AND l.i >= up.i AND l.i < up.stop GROUP BY up.doc_id, up.i),
         starts AS (SELECT doc_id, i, lv, coalesce(sum(length('S ' || i || ' ' || body) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS begin_at FROM l)
       SELECT doc_id, CAST(i AS INT) AS nth, 'S ' || i AS heading, CAST(lv AS INT) AS heading_level, section_path, md5(text) AS digest, begin_at AS char_offset_start,
         CAST(begin_at + length('S ' || i) + length(text) AS INT) AS char_offset_end FROM whole JOIN texts USING (doc_id, i) JOIN starts USING (doc_id, i)"""
)
def nested_sections(spark, sf_dir):
    """Every line of a document under a heading of its own, one to four levels deep: whole section texts, paths and offsets."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    number = lambda i: i.cast("string")

    def part(line, i):
        level = number((i * i + F.col("doc_id")) % 4 + 1)
        return F.concat(F.lit("<h"), level, F.lit(">S "), number(i), F.lit("</h"), level, F.lit("><p>"), number(i), F.lit(" "), F.md5(line.cast("binary")), F.lit("</p>"))

    html = F.concat(F.lit("<html><body><article>"), F.array_join(F.transform(lines, part), ""), F.lit("</article></body></html>"))
    pages = spread(table(spark, sf_dir, "documents")).select("doc_id", F.concat(F.lit("http://s.example.com/"), F.col("doc_id").cast("string")).alias("url"), html.alias("html"))
    found = K.extract_pages(pages.withColumnRenamed("doc_id", "number"), reduce=False).select("number", "sections")
    rows = explode_once(found, "sections", "nth", "s")
    return rows.select(
        F.col("number").alias("doc_id"), "nth", F.col("s.heading_text").alias("heading"), "s.heading_level", F.array_join("s.section_path", " > ").alias("section_path"),
        F.md5(F.col("s.text").cast("binary")).alias("digest"), "s.char_offset_start", "s.char_offset_end",
    )
