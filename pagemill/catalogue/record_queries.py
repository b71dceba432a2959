"""Records: seeds, aliases, payload documents, exports, summaries, JSON access."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalogue import query, table
from pagemill.functions import payloads as J
from pagemill.operators import alias as A
from pagemill.operators import export as X
from pagemill.operators import summary as S
from pagemill.operators.keyed import insert_if_absent, merge_queues, upsert, without_keys
from pagemill.session import spread


def text(col: str):
    return F.col(col).cast("string")


@query(
    """SELECT o_orderkey, CASE o_orderkey % 6
         WHEN 0 THEN 'https://arxiv.org/abs/' || o_orderkey WHEN 1 THEN 'https://www.amazon.com/s?k=top%20' || o_custkey || '%2F1'
         WHEN 2 THEN 'https://www.linkedin.com/search/results/people/?keywords=' || replace(o_orderpriority, ' ', '%20')
         WHEN 3 THEN 'https://en.wikipedia.org/wiki/Order_' || o_orderkey WHEN 4 THEN 'http://given.example.com/' || o_orderkey END AS canonical_url,
       CASE WHEN o_orderkey % 6 = 4 THEN 'canonicalized_input' ELSE 'template_construction' END AS discovery_mode,
       CASE WHEN o_orderkey % 6 = 0 THEN 'https://arxiv.org/pdf/' || o_orderkey || '.pdf' END AS pdf_url,
       CASE WHEN o_orderkey % 6 = 5 THEN 'missing field address' END AS error FROM orders"""
)
def seed_build(spark, sf_dir):
    key, kind = text("o_orderkey"), F.col("o_orderkey") % 6

    def record(platform: str, resource: str, *pairs):
        flat = [F.lit(x) if isinstance(x, str) else x for x in ("platform", platform, "resource_type", resource, *pairs)]
        return F.create_map(*flat)

    maps = (
        record("arxiv", "paper", "paper_id", F.lit(""), "post_id", key),
        record("amazon", "search", "keyword", F.concat(F.lit("top "), text("o_custkey"), F.lit("/1"))),
        record("linkedin", "search", "search_type", " Profile", "keywords", F.col("o_orderpriority")),
        record("wikipedia", "article", "page_title", F.concat(F.lit("Order "), key)),
        record("base", "token", "canonical_url", F.concat(F.lit("http://given.example.com/"), key)),
        record("base", "address", "tx_hash", key),
    )
    own = maps[-1]
    for i, m in reversed(list(enumerate(maps[:-1]))):
        own = F.when(kind == i, m).otherwise(own)
    rows = A.candidates(spread(table(spark, sf_dir, "orders")).select("o_orderkey", own.alias("record")))
    return rows.select(
        "o_orderkey", "canonical_url", "discovery_mode", F.try_element_at("artifacts", F.lit("pdf_url")).alias("pdf_url"), "error"
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'amazon' ELSE 'arxiv' END AS platform,
         'T' || o_orderkey AS title, 'meta ' || o_orderstatus AS summary, 'meta ' || o_orderstatus AS extract,
         'meta ' || o_orderstatus AS abstract, 'body ' || o_orderkey AS full_text, 'deep' || o_custkey AS price,
         CASE WHEN o_orderkey % 2 = 0 THEN 'maker' END AS brand, CASE WHEN o_orderkey % 2 = 0 THEN 'Prime' END AS fulfillment,
         '{"inner":{"current_price":"deep' || o_custkey || '"},"manufacturer":"maker"}' AS structured FROM orders"""
)
def alias_coalesce(spark, sf_dir):
    key = text("o_orderkey")
    structured = F.concat(F.lit('{"inner":{"current_price":"deep'), text("o_custkey"), F.lit('"},"manufacturer":"maker"}'))
    platform = F.when(F.col("o_orderkey") % 2 == 0, F.lit("amazon")).otherwise(F.lit("arxiv"))
    kind = F.when(F.col("o_orderkey") % 2 == 0, F.lit("product")).otherwise(F.lit("paper"))
    record = F.create_map(
        F.lit("canonical_url"), F.concat(F.lit("http://x.example.com/"), key), F.lit("platform"), platform,
        F.lit("resource_type"), kind, F.lit("title"), F.concat(F.lit("T"), key), F.lit("plain_text"),
        F.concat(F.lit("body "), key), F.lit("summary"), F.lit(""), F.lit("shipping_type"), F.lit("Prime"),
    )
    metadata = F.create_map(F.lit("description"), F.concat(F.lit("meta "), F.col("o_orderstatus")))
    rows = spread(table(spark, sf_dir, "orders")).select(
        "o_orderkey", structured.alias("structured"), record.alias("record"), metadata.alias("metadata")
    )
    rows = rows.withColumn("flat", A.flatten_json(F.col("structured")))
    rows = rows.withColumn("fields", A.enrichment_input(F.col("record"), F.col("flat"), F.col("metadata")))
    out = rows.select("o_orderkey", "structured", A.apply_aliases(F.col("fields")).alias("fields"))
    names = ("platform", "title", "summary", "extract", "abstract", "full_text", "price", "brand", "fulfillment")
    return out.select("o_orderkey", "structured", *[F.try_element_at("fields", F.lit(n)).alias(n) for n in names])


@query(
    """SELECT o_orderkey, 'nested' || o_orderkey AS k, 'x' || o_orderkey AS deep, '{"deep":"x' || o_orderkey || '"}' AS e,
         CAST(NULL AS VARCHAR) AS hollow, o_orderstatus AS late, '[1,2]' AS list FROM orders"""
)
def flatten_deep(spark, sf_dir):
    key = text("o_orderkey")
    payload = F.concat(
        F.lit('{"first":{"k":"nested'), key, F.lit('","hollow":"","b":{"c":{"d":{"e":{"deep":"x'), key,
        F.lit('"}}}},"hollow":{}},"k":"shallow","late":"'), F.col("o_orderstatus"), F.lit('","list":[1,2]}'),
    )
    flat = table(spark, sf_dir, "orders").select("o_orderkey", A.flatten_json(payload).alias("flat"))
    return flat.select("o_orderkey", *[F.try_element_at("flat", F.lit(n)).alias(n) for n in ("k", "deep", "e", "hollow", "late", "list")])


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing,
         event_type || chr(10) || chr(10) || 'k: ' || json_extract(props, '$.k') AS plain_text,
         '# ' || event_type || chr(10) || chr(10) || '**k**: ' || json_extract(props, '$.k') AS markdown FROM events"""
)
def json_props(spark, sf_dir):
    shown = J.render_document(F.col("event_type"), F.lit(""), J.as_map(F.col("props")))
    rows = table(spark, sf_dir, "events").select("event_id", "props", shown.alias("d"))
    return rows.select(
        "event_id", J.at(F.col("props"), "$.k").cast("bigint").alias("k"), J.at(F.col("props"), "$.x.y").alias("missing"),
        "d.plain_text", "d.markdown",
    )


@query(
    """SELECT c_custkey, 'u' || c_custkey AS source_id, c_name AS title, 'About ' || c_mktsegment AS description,
         'Town ' || c_nationkey AS headquarters, c_custkey * 10 AS follower_count, 'https://img/big' || c_custkey AS logo_url,
         c_mktsegment AS industry, 'urn-tail' || c_custkey AS profile_id, c_mktsegment AS headline,
         'Place ' || c_nationkey AS job_location, '2023-11-14T22:13:20Z' AS published_at, c_name AS job_company FROM customer"""
)
def entity_graph(spark, sf_dir):
    key, nation, segment, name = text("c_custkey"), text("c_nationkey"), F.col("c_mktsegment"), F.col("c_name")
    parts = (
        '{"data":{"x":[{"elements":[{"$type":"a.Company","entityUrn":"urn:li:fsd_company:u', key, '","name":"', name,
        '","universalName":"s","multiLocaleDescriptions":{"localized":{"de_DE":"nein","en_US":"About ', segment,
        '"},"preferredLocale":{"language":"en","country":"US"}},"headquarter":{"city":"Town ', nation,
        '"},"*followingInfo":"urn:f:1","industries":["', segment, '"],"logo":{"image":{"rootUrl":"https://img/","artifacts":',
        '[{"width":10,"fileIdentifyingUrlPathSegment":"small"},{"width":90,"fileIdentifyingUrlPathSegment":"big', key, '"}]}}},',
        '{"$type":"a.Company","name":""}]}]},"included":[{"entityUrn":"urn:f:1","followerCount":', (F.col("c_custkey") * 10).cast("string"), "},",
        '{"$type":"p.Profile","entityUrn":"urn:li:fsd_profile:urn-tail', key, '","firstName":"A","headline":"', segment, '"},',
        '{"$type":"j.JobPosting","title":"T","description":{"text":"d"},"*location":"urn:l:1","listedAt":1700000000000,"entityUrn":"urn:j:1"},',
        '{"entityUrn":"urn:l:1","defaultLocalizedName":"Place ', nation, '"}]}',
    )
    payload = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    rows = spread(table(spark, sf_dir, "customer")).select("c_custkey", J.graph_items(payload).alias("items"))
    items = F.col("items")
    rows = rows.select(
        "c_custkey", J.company(items).alias("c"), J.profile(items).alias("p"), J.job(items).alias("j"),
    )
    return rows.select(
        "c_custkey", "c.source_id", "c.title", "c.description", "c.headquarters", "c.follower_count", "c.logo_url",
        "c.industry", F.col("p.source_id").alias("profile_id"), "p.headline", F.col("j.location").alias("job_location"),
        "j.published_at", F.col("j.company_name").alias("job_company"),
    )


@query(
    """SELECT doc_id, 'On ' || source || ' ${x}$' AS title, 'On ' || source || ' x' AS title_normalized,
         'Ann Lee|Bo Y. Tan' AS authors, 'Lee|Tan' AS last_names, 'cs.CL,cs.AI' AS categories,
         'cs,cs.CL,Natural language processing' AS topic_hierarchy, '10.1/' || doc_id AS doi,
         'http://pdf.example.org/' || doc_id AS pdf_url, 'https://github.com/a/' || doc_id AS code_url,
         'https://data.example.org/' || doc_id AS dataset_url, '1999.00001' AS related, 2 AS sections FROM documents"""
)
def atom_paper(spark, sf_dir):
    key = text("doc_id")
    parts = (
        '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><title>q</title><entry><title>On ',
        F.col("source"), "\n  ${x}$</title><summary> See https://github.com/a/", key, " and https://data.example.org/", key,
        " in 1999.00001 not 2101.00001v3 </summary><author><name>Ann Lee</name></author><author><name> Bo Y.  Tan </name></author>",
        '<arxiv:doi>10.1/', key, '</arxiv:doi><link type="text/html" href="h"/><link type="application/pdf" href="http://pdf.example.org/',
        key, '"/><arxiv:primary_category term="cs.CL"/><category term="cs.CL"/><category term="cs.AI"/></entry></feed>',
    )
    xml = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    paper = J.paper(xml, F.lit("https://arxiv.org/abs/2101.00001v1"))
    rows = table(spark, sf_dir, "documents").select("doc_id", paper.alias("p"))
    return rows.select(
        "doc_id", "p.title", "p.title_normalized", F.array_join("p.authors", "|").alias("authors"),
        F.array_join(F.transform("p.authors_structured", lambda a: a["last_name"]), "|").alias("last_names"),
        F.array_join("p.categories", ",").alias("categories"), F.array_join("p.topic_hierarchy", ",").alias("topic_hierarchy"),
        "p.doi", "p.pdf_url", "p.code_url", "p.dataset_url", F.array_join("p.related_paper_ids", ",").alias("related"),
        F.size("p.sections_structured").alias("sections"),
    )


@query(
    """SELECT lang AS dataset_id, 'https://d.example.com/' || doc_id AS url,
         CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN 'cleaned ' || doc_id ELSE '' END AS cleaned_data,
         CASE WHEN doc_id % 2 = 0 THEN '2026-01-01T00:00:00Z' ELSE '2026-02-02T00:00:00Z' END AS crawl_timestamp FROM documents"""
)
def submission_projection(spark, sf_dir):
    key = F.col("doc_id")
    address = F.concat(F.lit(" https://d.example.com/"), text("doc_id"))
    rows = table(spark, sf_dir, "documents").select(
        "lang",
        F.when(key % 2 == 0, address).otherwise(F.lit("")).alias("canonical_url"),
        address.alias("url"),
        F.when(key % 3 == 0, F.col("text")).otherwise(F.lit("")).alias("plain_text"),
        F.when(key % 3 == 1, F.concat(F.lit("cleaned "), text("doc_id"))).alias("cleaned_data"),
        F.lit("").alias("markdown"),
        F.lit("{}").alias("structured"),
        F.when(key % 2 == 0, F.lit("2026-01-01T00:00:00Z")).alias("crawl_timestamp"),
    )
    entries = X.submission_entries(rows, F.col("lang"), F.lit("2026-02-02T00:00:00Z"))
    return entries.select("dataset_id", "url", "cleaned_data", "crawl_timestamp")


@query(
    """SELECT lang AS dataset_id, count(*) AS entries, CAST(sum(length(text)) AS BIGINT) AS chars, TRUE AS bounded,
         TRUE AS filled FROM documents GROUP BY lang"""
)
def submission_requests(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "lang", F.concat(F.lit("https://d.example.com/"), text("doc_id")).alias("canonical_url"), F.lit("").alias("url"),
        F.col("text").alias("plain_text"), F.lit("").alias("cleaned_data"), F.lit("").alias("markdown"),
        F.lit("{}").alias("structured"), F.lit("2026-01-01T00:00:00Z").alias("crawl_timestamp"),
    )
    requests = X.submission_requests(X.submission_entries(rows, F.col("lang")), entries_per_request=50)
    sizes = F.aggregate("entries", F.lit(0).cast("bigint"), lambda n, e: n + F.length(e["cleaned_data"]))
    # Only the last request of each task's share may be short.
    tasks = F.count_distinct(F.shiftright("request", 32))
    return requests.groupBy("dataset_id").agg(
        F.sum(F.size("entries")).alias("entries"), F.sum(sizes).alias("chars"), (F.max(F.size("entries")) <= 50).alias("bounded"),
        (F.count("*") <= F.ceil(F.sum(F.size("entries")) / 50) + tasks).alias("filled"),
    )


@query(
    """SELECT o_orderkey, 'T' || o_orderkey AS title, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority,
         'body' AS content, 'http://x/' || o_orderkey AS url, 'meta' AS note, CAST(NULL AS VARCHAR) AS extra FROM orders"""
)
def schema_projection(spark, sf_dir):
    key = text("o_orderkey")
    values = F.when(
        F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("priority"), F.col("o_orderpriority"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    record = F.create_map(F.lit("title"), F.concat(F.lit("T"), key), F.lit("extra"), F.lit("unasked"))
    metadata = F.create_map(F.lit("note"), F.lit("meta"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", values.alias("v"), F.concat(F.lit("http://x/"), key).alias("u"))
    resolved = X.resolve_fields(F.col("u"), record, metadata, F.col("v"), F.lit("body"), F.lit("item"))
    schema = {"title": True, "priority": False, "content": True, "url": True, "note": True, "extra": False}
    out = X.project_to_schema(rows.withColumn("r", resolved), schema, F.col("v"), F.col("r"))
    return out.select("o_orderkey", *[F.try_element_at("structured_data", F.lit(n)).alias(n) for n in schema])


@query(
    """WITH c AS (SELECT o_orderpriority AS grp, count(*) FILTER (WHERE o_orderstatus <> 'F') AS ok, count(*) FILTER (WHERE o_orderstatus = 'F') AS bad FROM orders GROUP BY 1
          UNION ALL SELECT 'none', count(*), 0 FROM nation)
        SELECT grp, ok AS records_succeeded, bad AS records_failed, ok + bad AS records_total,
          CASE WHEN ok + bad > 0 AND ok = 0 THEN 'failed' WHEN bad > 0 THEN 'partial_success' ELSE 'success' END AS status,
          CASE WHEN bad > 0 THEN 'inspect errors.jsonl' ELSE 'none' END AS next_action FROM c"""
)
def run_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("grp"), (F.col("o_orderstatus") == "F").alias("failed")
    ).unionByName(table(spark, sf_dir, "nation").select(F.lit("none").alias("grp"), F.lit(False).alias("failed")))
    return S.run_summary(rows, F.col("failed"), ["grp"])


@query(
    """SELECT event_id, event_type AS error_code, 'complete login in auto-browser and retry' AS next_action,
         'http://e/' || event_id AS public_url FROM events WHERE event_type = 'error' AND user_id % 2 = 0
       UNION ALL SELECT event_id, 'AUTH_EXPIRED', 'x', 'http://login/' FROM events WHERE event_type = 'signup'"""
    .replace("event_type AS error_code", "'CAPTCHA' AS error_code")
)
def sign_in_pending(spark, sf_dir):
    kind = F.col("event_type")
    code = F.when((kind == "error") & (F.col("user_id") % 2 == 0), F.lit("CAPTCHA")).when(
        kind == "signup", F.lit("AUTH_EXPIRED")
    ).otherwise(F.lit("SERVER_ERROR"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", code.alias("error_code"), F.when(kind == "signup", F.lit("x")).otherwise(F.lit("")).alias("next_action"),
        F.lit("").alias("public_url"), F.when(kind == "signup", F.lit("http://login/")).alias("login_url"),
        F.concat(F.lit("http://e/"), text("event_id")).alias("url"),
    )
    return S.sign_in_pending(rows).select("event_id", "error_code", "next_action", "public_url")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'click')")
def dead_letters(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("retryable", F.col("event_type").isin("error", "click"))
    return S.dead_letters(rows).select("event_id", "event_type")


@query(
    """SELECT o_orderkey AS k, 'old' AS v FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
       UNION ALL SELECT DISTINCT l_orderkey, 'new' FROM lineitem WHERE l_returnflag = 'R'"""
)
def upsert_rows(spark, sf_dir):
    current = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.lit("old").alias("v"))
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return upsert(current, returned.select(F.col("l_orderkey").alias("k"), F.lit("new").alias("v")).distinct(), ["k"])


@query(
    """SELECT o_custkey AS k, 'seen' AS v FROM orders GROUP BY o_custkey
       UNION ALL SELECT c_custkey, 'fresh' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
)
def insert_absent(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.lit("seen").alias("v")).distinct()
    return insert_if_absent(seen, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("fresh").alias("v")), ["k"])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_filter(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return without_keys(docs, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    """WITH q AS (SELECT user_id AS item, 0 AS q, event_id AS position, 'view' AS v FROM events WHERE event_type = 'view'
          UNION ALL SELECT user_id, 1, event_id, 'error' FROM events WHERE event_type = 'error')
        SELECT item, arg_max(v, q * 1000000000 + position) AS v, min(q * 1000000000 + position) % 1000000000 AS position FROM q GROUP BY item"""
)
def merge_work_queues(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    queues = [
        events.filter(F.col("event_type") == kind).select(
            F.col("user_id").alias("item"), F.col("event_id").alias("position"), F.lit(kind).alias("v")
        )
        for kind in ("view", "error")
    ]
    return merge_queues(queues, "item")


@query(
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'address' ELSE 'T' || c_custkey END AS title,
         CASE c_custkey % 3 WHEN 0 THEN 'Short ' || c_custkey WHEN 1 THEN '{"hash":"h' || c_custkey || '"}' ELSE 'D' || c_custkey END AS description,
         CASE c_custkey % 3 WHEN 0 THEN c_name || chr(10) || 'Body of ' || c_name WHEN 1 THEN 'json' || chr(10) || '{"hash":"h' || c_custkey || '"}'
           ELSE 'T' || c_custkey || chr(10) || 'D' || c_custkey || chr(10) || 'k: ' || c_mktsegment END AS plain_text,
         CASE c_custkey % 3 WHEN 0 THEN c_mktsegment END AS category, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR) END AS page_id,
         CASE c_custkey % 3 WHEN 1 THEN '{"hash":"h' || c_custkey || '"}' END AS rpc_result,
         CASE c_custkey % 3 WHEN 2 THEN c_mktsegment END AS k, 'success' AS status FROM customer"""
)
def crawl_structured(spark, sf_dir):
    """API answers of several platforms in one table: each by the rule of its own platform."""
    from pagemill.plans.crawl import crawl_records

    key = text("c_custkey")
    rest = F.col("c_custkey") % 3
    article = F.concat(
        F.lit('{"query":{"pages":{"1":{"pageid":'), key, F.lit(',"title":"'), F.col("c_name"), F.lit('","extract":"Body of '), F.col("c_name"),
        F.lit('","categories":[{"title":"Category:'), F.col("c_mktsegment"), F.lit('"}],"pageprops":{"wikibase-shortdesc":"Short '), key, F.lit('"}}}}}'),
    )
    answer = F.concat(F.lit('{"jsonrpc":"2.0","id":1,"result":{"hash":"h'), key, F.lit('"}}'))
    plain = F.concat(F.lit('{"title":"T'), key, F.lit('","description":"D'), key, F.lit('","k":"'), F.col("c_mktsegment"), F.lit('"}'))
    pages = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("http://api.example.com/"), key).alias("url"), F.lit("").alias("html"),
        F.when(rest == 0, "wikipedia").when(rest == 1, "base").otherwise("generic").alias("platform"),
        F.when(rest == 1, "address").otherwise("page").alias("resource_type"),
        F.when(rest == 0, article).when(rest == 1, answer).otherwise(plain).alias("json_data"),
    )
    found = crawl_records(pages)
    return found.select(
        F.substring_index("canonical_url", "/", -1).cast("bigint").alias("c_custkey"), "title", "description", "plain_text",
        J.at(F.col("structured"), "$.categories[0]").alias("category"), J.at(F.col("structured"), "$.page_id").alias("page_id"),
        J.at(F.col("structured"), "$.rpc_result").alias("rpc_result"), J.at(F.col("structured"), "$.k").alias("k"), "status",
    )


@query(
    """SELECT c_custkey, CASE c_custkey % 6
         WHEN 0 THEN '{"page_id":"' || c_custkey || '","summary":"' || c_mktsegment || '","title":"' || c_name || '"}'
         WHEN 1 THEN '{"abstract":"From ' || c_mktsegment || '","arxiv_id":"' || c_custkey || '"}'
         WHEN 2 THEN '{"asin":"' || c_custkey || '","price":"$' || c_nationkey || '","tags":["' || c_mktsegment || '"],"title":"' || c_name || '"}'
         WHEN 3 THEN '{"identifier":"' || c_custkey || '","title":"' || c_name || '"}'
         WHEN 4 THEN '{"headline":"' || c_mktsegment || '","public_identifier":"own","title":"' || c_name || '"}'
         ELSE '{"source_url":"http://x/' || c_custkey || '","title":"' || c_name || '"}' END AS fields FROM customer"""
)
def normalised_records(spark, sf_dir):
    """Records of six platforms in one table, each normalised by its platform's rule."""
    from pagemill.functions.hooks import normalised

    key, kind = text("c_custkey"), F.col("c_custkey") % 6
    platform = F.element_at(F.array(*[F.lit(p) for p in ("wikipedia", "arxiv", "amazon", "base", "linkedin", "other")]), (kind + 1).cast("int"))
    fields = F.create_map(F.when(kind == 1, "arxiv_id").when(kind == 2, "asin").when(kind == 4, "public_identifier").otherwise("address"), key)
    metadata = F.create_map(
        F.lit("title"), F.when(kind != 0, F.col("c_name")), F.lit("page_id"), key, F.lit("source_url"), F.concat(F.lit("http://x/"), key), F.lit("description"), F.lit("")
    )
    structured = (
        F.when(kind == 1, F.concat(F.lit('{"abstract_plain_text":"From '), F.col("c_mktsegment"), F.lit('"}')))
        .when(kind == 2, F.concat(F.lit('{"title":"no","price":"$'), text("c_nationkey"), F.lit('","tags":["'), F.col("c_mktsegment"), F.lit('"],"none":[],"blank":"","null":null}')))
        .when(kind == 4, F.concat(F.lit('{"public_identifier":"own","headline":"'), F.col("c_mktsegment"), F.lit('"}'))).otherwise("not JSON")
    )
    plain = F.concat(F.col("c_mktsegment"), F.lit("\nsecond line"))
    record = F.create_map(F.lit("title"), F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", normalised(platform, record, fields, metadata, plain, structured).alias("fields"))
