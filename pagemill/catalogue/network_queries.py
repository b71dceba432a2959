"""Payloads of the network platform, platforms in one traversal, expansion, nested variant prices, pointers."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalogue import query, table
from pagemill.functions import html as H
from pagemill.functions import json_rows as R
from pagemill.functions import page_fields as P
from pagemill.functions import payloads as J
from pagemill.operators import expand as E
from pagemill.operators import traverse as V
from pagemill.operators.merge import merged_payloads as merge
from pagemill.session import spread


def text(col: str):
    return F.col(col).cast("string")


def joined(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query(
    """SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS last_status, min(o_orderkey) AS first_order, max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END) AS even_order,
         string_agg('urn:o:' || o_orderkey, ',' ORDER BY o_orderkey) AS urns, count(*) AS n_elements, count(*) FILTER (o_orderkey % 3 = 0) AS n_skipped
       FROM orders GROUP BY o_custkey"""
)
def merged_payloads(spark, sf_dir):
    """The answers about a customer's orders merged into one document: last key wins, lists are strung together."""
    key = text("o_orderkey")
    payload = joined(
        '{"status":"', F.col("o_orderstatus"), '","included":[{"entityUrn":"urn:o:', key, '"},7],"data":{"elements":[{"n":', key, "}],",
        F.when(F.col("o_orderkey") % 2 == 0, joined('"even":', key, ",")).otherwise(""), '"skipped":', F.when(F.col("o_orderkey") % 3 == 0, "null").otherwise("1"), "}}",
    )
    every = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", payload.alias("payload"))
    broken = every.where("o_orderkey % 5 = 0").select("o_custkey", F.col("o_orderkey") + 1, F.lit("not JSON"))
    firsts = every.select("o_custkey", (-F.col("o_orderkey")).alias("o_orderkey"), joined('{"first":', key, "}").alias("payload"))
    found = merge(every.union(broken).union(firsts), ["o_custkey"], "o_orderkey").withColumn("d", F.parse_json("payload"))
    get = lambda path, kind: F.try_variant_get("d", path, kind)
    listed = get("$.included", "array<struct<entityUrn:string>>")
    return found.select(
        "o_custkey", get("$.status", "string").alias("last_status"), get("$.first", "bigint").alias("first_order"), get("$.data.even", "bigint").alias("even_order"),
        F.array_join(F.transform(listed, lambda x: x["entityUrn"]), ",").alias("urns"),
        F.size(get("$.data.elements", "array<variant>")).cast("bigint").alias("n_elements"),
    ).join(every.groupBy("o_custkey").agg(F.count_if(F.col("o_orderkey") % 3 == 0).alias("n_skipped")), "o_custkey")


@query(
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN 'Ann ' || c_name WHEN 2 THEN 'Job ' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS title,
         CASE c_custkey % 4 WHEN 0 THEN c_name || chr(10) || 'About ' || c_mktsegment WHEN 1 THEN 'Ann ' || c_name || chr(10) || c_mktsegment
           WHEN 2 THEN 'Job ' || c_custkey || chr(10) || 'Do ' || c_mktsegment ELSE '{"k":' || c_custkey || '}' END AS plain_text,
         CASE c_custkey % 4 WHEN 0 THEN 'organization' WHEN 1 THEN 'person' WHEN 2 THEN 'job' END AS entity_type,
         CASE WHEN c_custkey % 4 < 3 THEN 'u' || c_custkey END AS source_id, CASE c_custkey % 4 WHEN 2 THEN '2023-11-14T22:13:20Z' END AS published_at,
         CASE c_custkey % 4 WHEN 2 THEN c_name END AS company_name, 'json_structured' AS how FROM customer"""
)
def network_documents(spark, sf_dir):
    """Network payloads as records: companies, persons and jobs by their own projection, posts as they are."""
    from pagemill.plans.crawl import crawl_records

    key, rest, name, segment = text("c_custkey"), F.col("c_custkey") % 4, F.col("c_name"), F.col("c_mktsegment")
    payload = (
        F.when(rest == 0, joined('{"included":[{"$type":"x.Company","entityUrn":"urn:li:fsd_company:u', key, '","name":"', name, '","description":"About ', segment, '"}]}'))
        .when(rest == 1, joined('{"data":{"elements":[{"$type":"x.Profile","entityUrn":"urn:p:u', key, '","firstName":"Ann","lastName":"', name, '","headline":"', segment, '"}]}}'))
        .when(rest == 2, joined(
            '{"included":[{"$type":"x.JobPosting","entityUrn":"urn:j:u', key, '","title":"Job ', key, '","description":{"text":"Do ', segment,
            '"},"listedAt":1700000000000,"companyDetails":{"name":"', name, '"}}]}',
        ))
        .otherwise(joined('{"k":', key, "}"))
    )
    kind = F.when(rest == 0, "company").when(rest == 1, "profile").when(rest == 2, "job").otherwise("post")
    place = F.when(rest == 0, "company/").when(rest == 1, "in/").when(rest == 2, "jobs/view/").otherwise("feed/update/urn:li:activity:")
    pages = table(spark, sf_dir, "customer").select(
        joined("https://www.linkedin.com/", place, key, "/").alias("url"), F.lit("").alias("html"), F.lit("linkedin").alias("platform"),
        kind.alias("resource_type"), payload.alias("json_data"),
    )
    found = crawl_records(pages, formats=("json",))
    at = lambda path: J.at(F.col("structured"), path)
    return found.select(
        F.regexp_extract("canonical_url", r"(\d+)/$", 1).cast("bigint").alias("c_custkey"), "title",
        F.when(F.col("resource_type") == "post", F.col("description")).otherwise(F.col("plain_text")).alias("plain_text"),
        at("$.entity_type").alias("entity_type"), at("$.source_id").alias("source_id"), at("$.published_at").alias("published_at"),
        at("$.company_name").alias("company_name"), F.col("chunking_strategy").alias("how"),
    )


_PLATFORMS = ("generic", "wikipedia", "amazon", "linkedin")
_TREE = """WITH RECURSIVE n AS MATERIALIZED (SELECT c_custkey % 4 AS g, c_custkey // 4 AS k FROM customer),
  walk AS (SELECT g, k, 0 AS d, k AS s, NULL::BIGINT AS p FROM n WHERE k % 60 = 0
    UNION ALL SELECT w.g, 3 * w.k + i, d + 1, s, w.k FROM walk w, range(1, 4) r(i) WHERE d < 3 AND EXISTS (SELECT 1 FROM n WHERE n.g = w.g AND n.k = w.k)),
  best AS (SELECT g, k, min(d) AS d, arg_min(s, d) AS s, arg_min(coalesce(p, -1), d) AS p FROM walk GROUP BY g, k)"""


def _address(platform, k):
    number = F.lpad(k.cast("string"), 9, "0")
    return (
        F.when(platform == "generic", F.concat(F.lit("http://g.example.com/n/"), number))
        .when(platform == "wikipedia", F.concat(F.lit("https://en.wikipedia.org/wiki/Page_"), number))
        .when(platform == "amazon", F.concat(F.lit("https://www.amazon.com/dp/B"), number))
        .otherwise(F.concat(F.lit("https://www.linkedin.com/company/c"), number, F.lit("/")))
    )


def _tree_pages(spark, sf_dir):
    """Every customer is a page that leads to three others of its platform, written as that platform writes links."""
    nodes = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 4).cast("int").alias("g"), F.expr("c_custkey div 4").alias("k"))
    nodes = nodes.withColumn("platform", F.element_at(F.array(*[F.lit(p) for p in _PLATFORMS]), F.col("g") + 1))
    child = [F.lpad((3 * F.col("k") + i).cast("string"), 9, "0") for i in (1, 2, 3)]
    each = lambda make: F.concat(*[make(c) for c in child])
    html = (
        F.when(F.col("g") == 0, each(lambda c: joined('<a title="x>y" href="/n/', c, '?q=1">n</a><a href="http://other.example.com/n/', c, '">o</a>')))
        .when(F.col("g") == 1, each(lambda c: joined('<a href="/wiki/Page_', c, '">a</a><a href="/wiki/File:', c, '.png">f</a>')))
        .when(F.col("g") == 2, joined('<a href="/dp/B', child[0], '?ref=1">p</a><a href="/gp/help/">h</a><script>{"asin" : "B', child[1], '"},{"asin":"B', child[2], '"}</script>'))
        .otherwise(joined('<a href="/company/c', child[0], '/?trk=1">c</a><a href="/company/c', child[1], '">c</a><code>https://www.linkedin.com/company/c', child[2], "/?x=1'</code>"))
    )
    return nodes.select("platform", "k", _address(F.col("platform"), F.col("k")).alias("url"), html.alias("html"))


@query(
    _TREE + """ SELECT CASE g WHEN 0 THEN 'generic' WHEN 1 THEN 'wikipedia' WHEN 2 THEN 'amazon' ELSE 'linkedin' END AS platform, best.k AS k,
         CAST(d AS INTEGER) AS hop_depth, s AS seed, CASE WHEN p >= 0 THEN p END AS parent,
         CASE WHEN d = 0 THEN 1.0 ELSE CASE g WHEN 0 THEN 0.3 WHEN 1 THEN 0.8 WHEN 2 THEN 0.7 ELSE 0.85 END END::DOUBLE AS score,
         CASE WHEN d = 0 THEN 'direct_input' ELSE CASE g WHEN 0 THEN 'page_links' WHEN 1 THEN 'api_lookup' ELSE 'search_results' END END AS discovery_mode,
         CASE WHEN d = 0 THEN NULL ELSE CASE g WHEN 1 THEN 'Page_' || lpad(CAST(best.k AS VARCHAR), 9, '0') WHEN 2 THEN 'B' || lpad(CAST(best.k AS VARCHAR), 9, '0') END END AS identity,
         CASE WHEN d = 0 THEN 'seed' ELSE CASE g WHEN 0 THEN 'page' WHEN 1 THEN 'article' WHEN 2 THEN 'product' ELSE 'company' END END AS resource_type,
         NOT EXISTS (SELECT 1 FROM n WHERE n.g = best.g AND n.k = best.k) AS failed FROM best"""
)
def crawl_three_levels(spark, sf_dir):
    """Four platforms walked three levels deep in one traversal; candidates without a page are errors."""
    pages = _tree_pages(spark, sf_dir)
    seeds = pages.where("k % 60 = 0").select("platform", F.col("url").alias("canonical_url"), F.lit("seed").alias("resource_type"), F.col("k").alias("ord"))
    records, errors = V.traverse(seeds, pages, 3)
    kinds = errors.select("platform", "canonical_url", "parent_url", "seed_url", "hop_depth").withColumn("failed", F.lit(True))
    number = lambda c: F.regexp_extract(c, r"(\d{9})/?$", 1).cast("bigint")
    shown = records.withColumn("failed", F.lit(False)).unionByName(kinds, allowMissingColumns=True)
    rule = {"generic": ("page", 0.3, "page_links"), "wikipedia": ("article", 0.8, "api_lookup"), "amazon": ("product", 0.7, "search_results"), "linkedin": ("company", 0.85, "search_results")}
    of = lambda i: F.create_map(*[F.lit(x) for p, v in rule.items() for x in (p, v[i])])[F.col("platform")]
    named = F.when(F.col("platform") == "wikipedia", joined("Page_", F.lpad(number(F.col("canonical_url")).cast("string"), 9, "0"))).when(
        F.col("platform") == "amazon", joined("B", F.lpad(number(F.col("canonical_url")).cast("string"), 9, "0")))
    # An error row says where it came from only; what it would have been follows from its platform.
    return shown.select(
        "platform", number(F.col("canonical_url")).alias("k"), "hop_depth", number(F.col("seed_url")).alias("seed"), number(F.col("parent_url")).alias("parent"),
        F.when(F.col("failed"), of(1)).otherwise(F.col("score")).alias("score"), F.when(F.col("failed"), of(2)).otherwise(F.col("discovery_mode")).alias("discovery_mode"),
        F.when(F.col("failed"), named).otherwise(F.col("identity")).alias("identity"), F.when(F.col("failed"), of(0)).otherwise(F.col("resource_type")).alias("resource_type"), "failed",
    )


@query(
    """WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, ['profile', 'company', 'post', 'job', 'page'][c_custkey % 5 + 1] AS kind FROM customer),
       p AS (SELECT k, kind, 'https://www.linkedin.com/' || CASE kind WHEN 'profile' THEN 'in/p' || k || '/' WHEN 'company' THEN 'company/c' || k || '/'
           WHEN 'post' THEN 'feed/update/urn:li:activity:' || k || '/' WHEN 'job' THEN 'jobs/view/' || k || '/' ELSE 'x/' || k END AS cand, n FROM c),
       own AS (SELECT * FROM p WHERE kind <> 'page' AND k % 7 <> 0),
       u AS (
         SELECT cand, kind, unnest([{u: 'https://www.linkedin.com/in/q' || n || '/', b: CASE kind WHEN 'profile' THEN 'profiles_others' ELSE 'profile' END},
           {u: 'https://www.linkedin.com/company/d' || n || '/', b: 'company'}], recursive := true) FROM own
         UNION ALL SELECT cand, kind, 'https://www.linkedin.com/in/p' || k || '/', 'profiles_self' FROM p WHERE kind = 'profile'
         UNION ALL SELECT cand, kind, 'https://www.linkedin.com/jobs/search/?currentJobId=' || (900000 + k), 'jobs_search' FROM p WHERE kind = 'company'
         UNION ALL SELECT cand, kind, 'https://www.linkedin.com/jobs/view/' || j || '/', 'job' FROM p, (VALUES (700001), (700002)) v(j) WHERE kind = 'company'
         UNION ALL SELECT cand, kind, 'https://www.linkedin.com/jobs/view/' || (900000 + k) || '/', 'job' FROM p WHERE kind = 'company'
         UNION ALL SELECT cand, kind, 'https://www.linkedin.com/company/s' || k || '/', 'company' FROM p WHERE kind = 'company'),
       g AS (SELECT cand, count(DISTINCT u) AS n_urls, string_agg(DISTINCT b, ',' ORDER BY b) AS buckets, md5(string_agg(DISTINCT u, ' ' ORDER BY u)) AS digest FROM u GROUP BY cand)
       SELECT p.k AS c_custkey, CASE kind WHEN 'page' THEN 'unknown' ELSE kind END AS kind, coalesce(n_urls, 0) AS n_urls, coalesce(buckets, '') AS buckets, digest,
         CASE kind WHEN 'page' THEN 0 WHEN 'company' THEN 2 + (k % 7 <> 0)::INT WHEN 'profile' THEN 1 + (k % 7 <> 0)::INT ELSE (k % 7 <> 0)::INT END::BIGINT AS pages,
         CASE kind WHEN 'company' THEN 1 ELSE 0 END::BIGINT AS search_pages, CASE kind WHEN 'company' THEN '700001,700002,' || (900000 + k) ELSE '' END AS job_ids,
         CASE WHEN kind = 'page' THEN 'not_expandable' WHEN kind <> 'company' AND k % 7 = 0 THEN 'page_missing' END AS error
       FROM p LEFT JOIN g USING (cand)"""
)
def expand_entities(spark, sf_dir):
    """Network entities expanded over their own pages, activity pages, tabs and the job searches those lead to."""
    number, nation = text("c_custkey"), text("c_nationkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", number.alias("k"), nation.alias("n"), F.element_at(F.array(*[F.lit(x) for x in ("profile", "company", "post", "job", "page")]), (F.col("c_custkey") % 5 + 1).cast("int")).alias("kind")
    )
    place = (
        F.when(F.col("kind") == "profile", joined("in/p", F.col("k"), "/")).when(F.col("kind") == "company", joined("company/c", F.col("k"), "/"))
        .when(F.col("kind") == "post", joined("feed/update/urn:li:activity:", F.col("k"), "/")).when(F.col("kind") == "job", joined("jobs/view/", F.col("k"), "/"))
        .otherwise(joined("x/", F.col("k")))
    )
    rows = rows.withColumn("cand", joined("https://www.linkedin.com/", place))
    search = joined("https://www.linkedin.com/jobs/search/?currentJobId=", (F.col("c_custkey") + 900000).cast("string"))
    own = rows.where("kind <> 'page' and c_custkey % 7 <> 0").select(
        F.col("cand").alias("url"), joined('<a href="/in/q', F.col("n"), '/#about">q</a><a href="/help/">h</a><a href="/company/d', F.col("n"), '/">d</a>').alias("html")
    )
    activity = rows.where("kind = 'profile'").select(F.concat("cand", F.lit("recent-activity/comments/")), joined('<a href="/in/p', F.col("k"), '/">me</a>'))
    tab = rows.where("kind = 'company'").select(F.concat("cand", F.lit("jobs/")), joined('<a href="', search, '">all</a><a href="/jobs/view/700001/">j</a>'))
    found = rows.where("kind = 'company'").select(search, joined('<a href="/company/s', F.col("k"), '/">s</a><code>originToLandingJobPostings=700002%2Cx</code>'))
    urls, summary = E.expand_entities(rows.select(F.col("cand").alias("url")), own.union(activity).union(tab).union(found))
    grouped = urls.groupBy("candidate").agg(
        F.count("*").alias("n_urls"), F.array_join(F.array_sort(F.collect_set("bucket")), ",").alias("buckets"),
        F.md5(F.array_join(F.array_sort(F.collect_list("url")), " ")).alias("digest"),
    )
    return summary.join(grouped, "candidate", "left").join(rows.select(F.col("cand").alias("candidate"), "c_custkey"), "candidate").select(
        "c_custkey", "kind", F.coalesce("n_urls", F.lit(0)).cast("bigint").alias("n_urls"), F.coalesce("buckets", F.lit("")).alias("buckets"), "digest",
        "pages", "search_pages", "job_ids", "error",
    )


@query(
    """SELECT c_custkey, 'R' || c_custkey || '=' || CASE WHEN c_custkey % 2 = 0 THEN '$' || c_nationkey || '.5' ELSE c_custkey || '.25' END || '/In Stock;'
         || 'G' || c_custkey || '=' || coalesce(CASE WHEN c_custkey % 3 = 0 THEN '7' END, '') || '/Unavailable;' || 'X' || c_custkey || '=/;' AS variants FROM customer"""
)
def variant_prices(spark, sf_dir):
    """Product variants with the prices that markup inside their captured answers shows, joined within the page's row."""
    key = text("c_custkey")
    slot = lambda asin, price, flag, markup: joined(
        '{\\"ASIN\\":\\"', asin, key, '\\",\\"Value\\":{\\"content\\":{\\"twisterSlotJson\\":{', price, '\\"isAvailable\\":', flag, '},\\"twisterSlotDiv\\":\\"', markup, '\\"}}}'
    )
    shown = F.when(F.col("c_custkey") % 2 == 0, joined("<div><span class='a-price'><span class='a-offscreen'>$", text("c_nationkey"), ".5</span></span></div>")).otherwise("<p>none</p>")
    price = F.when(F.col("c_custkey") % 3 == 0, '\\"price\\":7,').otherwise("")
    body = joined(slot("R", joined('\\"price\\":', key, ".25,"), "true", shown), "&&&", slot("G", price, "false", ""), "&&&{broken")
    html = joined(
        '<div id="twister"><ul><li data-asin="R', key, '" title=" Red "></li><li data-defaultasin="G', key, '"><img alt="Green"></li><li data-asin="X', key,
        '" title="X"></li></ul></div><script type="application/json" data-amazon-twister-responses="true">[{"body":"', body, '"},{"body":1}]</script>',
    )
    rows = spread(table(spark, sf_dir, "customer")).select("c_custkey", H.shred(html, F.lit("amazon")).alias("nodes"))
    rows = rows.withColumn("slots", J.variant_slots(P.variant_responses(F.col("nodes"))))
    rows = rows.withColumns({"prices": P.slot_prices(F.col("slots")), "embedded": J.embedded_variants(P.script_objects(F.col("nodes")))})
    rows = rows.select("c_custkey", P.priced_variants(F.col("nodes"), F.col("slots"), F.col("prices"), F.col("embedded")).alias("v"))
    line = lambda v: F.concat(v["asin"], F.lit("="), F.coalesce(v["price"], F.lit("")), F.lit("/"), F.coalesce(v["availability"], F.lit("")), F.lit(";"))
    return rows.select("c_custkey", F.array_join(F.transform("v", line), "").alias("variants"))


@query(
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN '"' || o_orderstatus || '"' WHEN 2 THEN '[' || o_orderkey || ',"' || o_orderpriority || '"]'
         WHEN 3 THEN '"' || o_orderpriority || '"' END AS value FROM orders"""
)
def json_pointer(spark, sf_dir):
    """A pointer of its own for every row: keys with slashes and tildes, list places, places that are not there."""
    key = text("o_orderkey")
    document = joined('{"a/b":{"c":', text("o_custkey"), '},"d~e":"', F.col("o_orderstatus"), '","list":[', key, ',"', F.col("o_orderpriority"), '"]}')
    pointers = F.array(*[F.lit(p) for p in ("/a~1b/c", "/d~0e", "/list", "/list/1", "/list/2")])
    rows = table(spark, sf_dir, "orders").select("o_orderkey", document.alias("d"), F.element_at(pointers, (F.col("o_orderkey") % 5 + 1).cast("int")).alias("p"))
    return rows.select("o_orderkey", R.value_at_pointer(F.col("d"), F.col("p")).alias("value"))


@query(
    """SELECT c_custkey, 'Firm ' || c_custkey || '|' || CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN '' ELSE 'Top line' END AS line FROM customer"""
)
def search_subtitles(spark, sf_dir):
    """The line beside each result of a search page: the first one within four elements up that isn't the title."""
    number, rest = text("c_custkey"), F.col("c_custkey") % 3
    title = joined('<a href="/company/c', number, '/">Firm ', number, "</a>")
    html = (
        F.when(rest == 0, joined("<div><div><p>far</p><ul><li><div><span>", title, "</span></div><p>", F.col("c_mktsegment"), "</p></li></ul></div></div>"))
        .when(rest == 1, joined("<html><body><div>", title, "</div></body></html>"))
        .otherwise(joined("<section><b>Top line</b><div><div><p>", title, "</p></div></div><i>later</i></section>"))
    )
    rows = spread(table(spark, sf_dir, "customer")).select("c_custkey", H.shred(html, F.lit("linkedin")).alias("nodes"))
    return rows.select("c_custkey", F.element_at(P.search_results(F.col("nodes")), 1).alias("r")).select("c_custkey", F.concat_ws("|", "r.title", "r.subtitle").alias("line"))


@query(
    """SELECT page_id, html IS NOT NULL AS valid, length(html) >= 200 AS ok,
         len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_links, html LIKE '%<title>%' AS has_title FROM pages"""
)
def crawl_css(spark, sf_dir):
    """Crawled pages with a CSS schema: one valid JSON document of the page's own fields and the schema's values."""
    from pagemill.plans.crawl import crawl_records

    schema = {"fields": {"links": {"selector": "nav a, aside a", "attribute": "href", "multiple": True}, "head": {"selector": "h1"}}}
    pages = table(spark, sf_dir, "pages").select("page_id", joined("http://c.example.com/", text("page_id")).alias("url"), "html")
    found = crawl_records(pages, formats=("html",), css_schema=schema).withColumn("v", F.try_parse_json("structured"))
    css = F.try_variant_get("v", "$.css.links", "array<string>")
    return found.select(
        F.regexp_extract("canonical_url", r"(\d+)$", 1).cast("bigint").alias("page_id"), F.col("v").isNotNull().alias("valid"), (F.col("status") == "success").alias("ok"),
        F.size(css).cast("bigint").alias("n_links"), F.try_variant_get("v", "$.title", "string").isNotNull().alias("has_title"),
    )
