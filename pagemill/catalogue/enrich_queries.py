"""Enrichment: pattern sets, dictionaries, field groups, answers, cache."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill import specs
from pagemill.catalogue import query, table
from pagemill.operators import enrich as E
from pagemill.session import spread

# Patterns made of corpus words, so the real texts are searched and do match.
WORD_PATTERNS = (
    (r"\b(the|of|and)\b", "english", "English words"),
    (r"\b(der|die|das)\b", "german", "German words"),
    (r"\b(le|les|aux)\b", "french", ""),
    (r"\b(License, Version|MIT License)\b", "license", "Licenses"),
)
GROUPS = ("the|of|and", "der|die|das", "le|les|aux", "License, Version|MIT License")


def doubled(words: str) -> str:
    """Alternatives as they look once every separator has been doubled."""
    for sign in (" ", "/", "-", ",", r"\."):
        words = words.replace(sign, sign * 2)
    return words


def matches_sql(text: str, groups) -> str:
    """All matches with an explicit boundary: RE2 knows only an ASCII word boundary.

    The explicit boundary consumes a separator, so separators are doubled first.
    """
    parts = [
        f"SELECT doc_id, {i} AS p, unnest(f) AS m, unnest(range(len(f))) AS i FROM (SELECT doc_id, regexp_extract_all("
        f"t, '(?i)(?:^|[^\\pL\\pN_])({doubled(words)})(?:$|[^\\pL\\pN_])', 1) AS f FROM t)"
        for i, words in enumerate(groups)
    ]
    return (
        f"t AS (SELECT doc_id, regexp_replace({text}, '([^\\pL\\pN_])', '\\1\\1', 'g') AS t FROM documents), "
        f"m AS MATERIALIZED ({' UNION ALL '.join(parts)})"
    )


_M = matches_sql("text", GROUPS)
_UNDOUBLE = "replace(replace(replace(replace(m, ',,', ','), '  ', ' '), '//', '/'), '--', '-')"
SKILL_TEXT = """'Kafka, ' || text || chr(10) || 'Python; Git and Rust. ' || CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German'
  WHEN 'fr' THEN 'French' ELSE 'Spanish' END"""
_S = matches_sql(SKILL_TEXT, [p[3:-3] for p, _, _ in specs.SKILL_PATTERNS])
_KINDS = "[" + ", ".join(f"'{c}'" for _, c, _ in specs.SKILL_PATTERNS) + "][p + 1]"


@query(
    f"""WITH {_M}, f AS (SELECT doc_id, {_UNDOUBLE} AS m, min(p * 100000000 + i) AS o FROM m GROUP BY ALL),
        c AS (SELECT doc_id, string_agg(DISTINCT CASE p WHEN 0 THEN 'english' WHEN 1 THEN 'german' WHEN 2 THEN 'french' ELSE 'license' END, ','
          ORDER BY CASE p WHEN 0 THEN 'english' WHEN 1 THEN 'german' WHEN 2 THEN 'french' ELSE 'license' END) AS categories FROM m GROUP BY doc_id),
        e AS (SELECT doc_id, string_agg(DISTINCT CASE p WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' ELSE '3' END, ',') AS x FROM m GROUP BY doc_id)
        SELECT d.doc_id, coalesce(string_agg(m, '|' ORDER BY o), '') AS items, coalesce(max(categories), '') AS categories,
          count(m) > 0 AS matched, CASE WHEN count(m) = 0 THEN 0 ELSE least((5 + count(m)) / 10.0, 0.9) END AS confidence
        FROM documents d LEFT JOIN f USING (doc_id) LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY d.doc_id"""
)
def pattern_matches(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = docs.select("doc_id", E.match_patterns(F.col("text"), WORD_PATTERNS).alias("r"))
    return rows.select(
        "doc_id", F.array_join("r.items", "|").alias("items"), F.array_join("r.categories", ",").alias("categories"),
        "r.matched", "r.confidence",
    )


# Skill names placed around every whole text; the texts hold few of their own.
@query(
    f"""WITH {_S}, f AS (SELECT doc_id, {_UNDOUBLE} AS m, min(p * 100000000 + i) AS o FROM m GROUP BY ALL),
        c AS (SELECT doc_id, string_agg(DISTINCT {_KINDS}, ',' ORDER BY {_KINDS}) AS categories FROM m GROUP BY doc_id)
        SELECT doc_id, string_agg(m, '|' ORDER BY o) AS items, max(categories) AS categories,
          least((5 + count(*)) / 10.0, 0.9) AS confidence, 'pattern:Programming Languages' AS first_evidence, 'success' AS status
        FROM f JOIN c USING (doc_id) GROUP BY doc_id"""
)
def skills_extract(spark, sf_dir):
    language = (
        F.when(F.col("lang") == "en", F.lit("English")).when(F.col("lang") == "de", F.lit("German"))
        .when(F.col("lang") == "fr", F.lit("French")).otherwise(F.lit("Spanish"))
    )
    text = F.concat(F.lit("Kafka, "), F.col("text"), F.lit("\nPython; Git and Rust. "), language)
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).select(
        "doc_id", E.match_patterns(text).alias("r")
    )
    return rows.select(
        "doc_id", F.array_join("r.items", "|").alias("items"), F.array_join("r.categories", ",").alias("categories"),
        "r.confidence", F.element_at("r.evidence", 1).alias("first_evidence"),
        F.when(F.col("r.confidence") >= 0.7, F.lit("success")).otherwise(F.lit("pending_agent")).alias("status"),
    )


LOOKUP = """dict AS (SELECT row_number() OVER (ORDER BY p_name) AS ord, p_name AS key FROM (SELECT DISTINCT p_name FROM part WHERE p_name NOT LIKE 'hot%')),
  v AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(replace(p_name, ' ', '-')) WHEN 2 THEN ' ' || p_name || ' deluxe'
    WHEN 3 THEN left(p_name, 5) ELSE 'zz' || p_name END AS value FROM part),
  n AS (SELECT *, trim(value) AS raw, translate(lower(trim(value)), '-_', '  ') AS q FROM v),
  x AS (SELECT n.*, e.key AS exact, m.key AS near FROM n LEFT JOIN dict e ON e.key = raw LEFT JOIN dict m ON m.key = q),
  p AS (SELECT p_partkey, key, ord, least(length(key), length(q)) AS ov FROM x JOIN dict ON starts_with(q, key) OR starts_with(key, q)
    WHERE exact IS NULL AND near IS NULL AND least(length(key), length(q)) >= 4),
  b AS (SELECT p_partkey, arg_max(key, ov * 100000 - ord) AS key, max(ov) AS ov FROM p GROUP BY p_partkey)"""


@query(
    f"""WITH {LOOKUP} SELECT x.p_partkey, coalesce(exact, near, b.key) AS match_key,
        CASE WHEN exact IS NOT NULL THEN 1.0 WHEN near IS NOT NULL THEN 0.85 WHEN b.key IS NOT NULL
          THEN round(least(ov / length(q) * 0.8, 0.75), 9) ELSE 0 END AS confidence FROM x LEFT JOIN b USING (p_partkey)"""
)
def title_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = part.select("p_name").distinct().filter(~F.col("p_name").like("hot%"))
    # The dictionary is small by nature; its order is the position of a key in it.
    dictionary = names.select(
        F.col("p_name").alias("key"), F.row_number().over(Window.orderBy("p_name")).alias("ord")
    )
    kind, name = F.col("p_partkey") % 5, F.col("p_name")
    value = (
        F.when(kind == 0, name).when(kind == 1, F.upper(F.replace(name, F.lit(" "), F.lit("-"))))
        .when(kind == 2, F.concat(F.lit(" "), name, F.lit(" deluxe"))).when(kind == 3, F.left(name, F.lit(5)))
        .otherwise(F.concat(F.lit("zz"), name))
    )
    out = E.lookup(part.select("p_partkey", value.alias("value")), "value", dictionary)
    return out.select("p_partkey", "match_key", F.round("confidence", 9).alias("confidence"))


_G = matches_sql(
    "CASE WHEN doc_id % 5 < 2 THEN text || chr(10) || 'Rust and Python' ELSE text END", [p[3:-3] for p, _, _ in specs.SKILL_PATTERNS]
)


@query(
    f"""WITH {_G}, f AS (SELECT doc_id, {_UNDOUBLE} AS m, min(p * 100000000 + i) AS o FROM m GROUP BY ALL),
        s AS (SELECT doc_id, string_agg(m, ',' ORDER BY o) AS items, least((5 + count(*)) / 10.0, 0.9) AS conf FROM f GROUP BY doc_id),
        d AS (SELECT doc_id, doc_id % 5 AS k, text, lang, items, coalesce(conf, 0) AS conf FROM documents LEFT JOIN s USING (doc_id)),
        g AS (SELECT doc_id, k, lang, items, conf, unnest(['skills_extraction', 'standardized_job_title', 'code', 'summaries', 'linkables', 'nope']) AS field_group FROM d)
        SELECT doc_id, field_group,
          CASE field_group WHEN 'skills_extraction' THEN CASE WHEN k = 4 THEN 'skipped' WHEN conf >= 0.7 THEN 'success' ELSE 'pending_agent' END
            WHEN 'standardized_job_title' THEN CASE WHEN k = 0 THEN 'success' WHEN k = 1 THEN 'pending_agent' ELSE 'skipped' END
            WHEN 'code' THEN CASE WHEN k <> 3 THEN 'success' ELSE 'skipped' END
            WHEN 'summaries' THEN 'pending_agent' WHEN 'linkables' THEN CASE WHEN k = 2 THEN 'partial' ELSE 'failed' END ELSE 'skipped' END AS status,
          CASE field_group WHEN 'skills_extraction' THEN CASE WHEN k <> 4 AND conf >= 0.7 THEN items END
            WHEN 'standardized_job_title' THEN CASE WHEN k = 0 THEN 'Title ' || lang END
            WHEN 'code' THEN CASE WHEN k <> 3 THEN lang END WHEN 'linkables' THEN CASE WHEN k = 2 THEN 'GitHub' END END AS value,
          CASE field_group WHEN 'skills_extraction' THEN CASE WHEN k <> 4 AND conf >= 0.7 THEN conf END
            WHEN 'standardized_job_title' THEN CASE WHEN k = 0 THEN 0.85 END
            WHEN 'code' THEN CASE WHEN k <> 3 THEN 0.6 END WHEN 'linkables' THEN CASE WHEN k = 2 THEN 0.6 END END AS confidence,
          CASE field_group WHEN 'skills_extraction' THEN CASE WHEN k = 4 THEN 'missing required source fields: [''plain_text'']' END
            WHEN 'standardized_job_title' THEN CASE WHEN k > 1 THEN 'missing required source fields: [''headline'']' END
            WHEN 'code' THEN CASE WHEN k = 3 THEN 'no routable source fields for code' END
            WHEN 'linkables' THEN CASE WHEN k <> 2 THEN 'no extractive match found' END
            WHEN 'nope' THEN 'unknown field group: nope' END AS error FROM g"""
)
def field_groups(spark, sf_dir):
    kind = F.col("doc_id") % 5
    skills = F.when(kind < 2, F.lit("\nRust and Python")).otherwise(F.lit(""))
    entries = F.filter(
        F.array(
            F.struct(F.lit("plain_text").alias("key"), F.when(kind != 4, F.concat(F.col("text"), skills)).alias("value")),
            F.struct(
                F.lit("headline").alias("key"),
                F.when(kind == 0, F.concat(F.lit("CHIEF_"), F.upper("lang"))).when(kind == 1, F.lit("Nobody at all")).alias("value"),
            ),
            F.struct(F.lit("language").alias("key"), F.when(kind != 3, F.col("lang")).alias("value")),
            F.struct(
                F.lit("canonical_url").alias("key"),
                F.when(kind == 2, F.lit("https://GitHub.example/x")).otherwise(F.lit("https://d.example.com/")).alias("value"),
            ),
        ),
        lambda e: e["value"].isNotNull(),
    )
    asked = F.array(*[F.lit(g) for g in ("skills_extraction", "standardized_job_title", "code", "summaries", "linkables", "nope")])
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        "doc_id", F.map_from_entries(entries).alias("fields"), asked.alias("field_groups")
    )
    titles = table(spark, sf_dir, "documents").select("lang").distinct().select(
        F.concat(F.lit("Chief "), F.col("lang")).alias("key"), F.ascii("lang").alias("ord"),
        F.create_map(F.lit("standardized_job_title"), F.concat(F.lit("Title "), F.col("lang"))).alias("values"),
    )
    out = E.run_groups(docs, E.builtin_groups(spark), titles)
    first = F.try_element_at(F.map_values("values"), F.lit(1))
    return out.select("doc_id", "field_group", "status", first.alias("value"), F.round("confidence", 6).alias("confidence"), "error")


@query(
    """SELECT d.doc_id, d.source AS field_group,
         CASE WHEN d.doc_id % 3 = 1 THEN 'success' WHEN l.doc_id IS NULL THEN 'pending_agent' WHEN quality = 1 THEN 'success' ELSE 'success' END AS status,
         CASE WHEN d.doc_id % 3 = 1 THEN 'old' WHEN l.doc_id IS NULL THEN NULL WHEN quality = 1 THEN 'good ' || d.doc_id ELSE 'plain words' END AS summary,
         CASE WHEN d.doc_id % 3 = 1 THEN CAST(0.5 AS DOUBLE) WHEN l.doc_id IS NOT NULL THEN 0.8 END AS confidence
       FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def fill_pending(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    old = F.col("doc_id") % 3 == 1
    results = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("field_group"), F.when(old, F.lit("success")).otherwise(F.lit("pending_agent")).alias("status"),
        F.when(old, F.create_map(F.lit("summary"), F.lit("old"))).alias("values"), F.when(old, F.lit(0.5)).alias("confidence"),
        F.array(F.lit("summary")).alias("output_fields"), F.concat(F.lit("id-"), key).alias("first_id"),
        F.concat(F.lit("u/"), key).alias("url_id"),
    )
    labels = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    # Half of the answers are keyed by the id, half by the address; some are not JSON.
    prefix = F.when(F.col("doc_id") % 2 == 0, F.lit("id-")).otherwise(F.lit("u/"))
    answer = F.when(
        F.col("quality") == 1, F.concat(F.lit('```json\n{"summary": "good '), key, F.lit('", "other": 1}\n```'))
    ).otherwise(F.lit("plain words"))
    responses = labels.select(F.concat(prefix, key, F.lit(":"), F.col("source")).alias("key"), answer.alias("response"))
    out = E.fill_pending(results, responses, ["first_id", "url_id"])
    return out.select("doc_id", "field_group", "status", F.try_element_at("values", F.lit("summary")).alias("summary"), "confidence")


@query(
    """SELECT doc_id, 'Field group: summaries' || chr(10) || 'Source fields:' || chr(10) || '  plain_text: ' || text || chr(10)
         || '  title: ' || source || chr(10) || chr(10) || 'Return a JSON object with the enriched fields based on the source data above.' AS fallback,
       'Read' || chr(10) || '**plain_text**: ' || text || chr(10) || chr(10) || '**title**: ' || source || chr(10) || chr(10) || 'for ' || source AS rendered
       FROM documents"""
)
def prompts(spark, sf_dir):
    fields = F.create_map(F.lit("title"), F.col("source"), F.lit("plain_text"), F.col("text"), F.lit("about"), F.lit(""))
    held = E.source_fields(fields, F.array().cast("array<string>"))
    template = (
        "Read\n{% for key, value in source_fields.items() %}**{{ key }}**: {{ value }}\n\n{% endfor %}"
        "for {{ source_fields.get('title') }}\n"
    )
    return table(spark, sf_dir, "documents").select("doc_id", held.alias("held"), "source").select(
        "doc_id", E.prompt(F.lit("summaries"), F.col("held")).alias("fallback"), E.render_template(template, F.col("held")).alias("rendered")
    )


@query(
    """SELECT o_custkey AS doc_id, o_orderstatus AS field_name, arg_max(o_orderpriority, o_orderkey) AS value FROM orders GROUP BY ALL"""
)
def merged_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"), "o_orderkey", F.create_map("o_orderstatus", "o_orderpriority").alias("values")
    )
    return E.merge_fields(rows, "o_orderkey")


@query(
    """SELECT doc_id, text IN (SELECT text FROM documents WHERE doc_id % 2 = 0) AS reused, 'success' AS status,
         CAST(length('Field group: summaries' || chr(10) || 'Source fields:' || chr(10) || '  plain_text: ' || text || chr(10) || '  title: t' || chr(10) || chr(10)
           || 'Return a JSON object with the enriched fields based on the source data above.') AS VARCHAR) AS summary FROM documents"""
)
def enrich_cached(spark, sf_dir):
    """Two batches over one cache: the second asks the model only for texts that the first one hasn't answered."""
    import uuid

    from pagemill.plans.enrich import enrich_cached as run
    from pagemill.session import shared_folder

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.create_map(F.lit("plain_text"), F.col("text"), F.lit("title"), F.lit("t")).alias("fields"), F.array(F.lit("summaries")).alias("field_groups")
    )
    folder, registry = f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}", E.builtin_groups(spark)
    answer = lambda prompts: prompts.map(lambda p: '{"summary": "%d"}' % len(p))
    run(docs.where("doc_id % 2 = 0"), registry, folder, "1", answer)
    second = run(docs, registry, folder, "2", answer)
    return second.select("doc_id", "reused", "status", F.element_at(F.map_values("values"), 1).alias("summary"))


@query(
    """WITH d AS (SELECT doc_id, n_chars, sum(n_chars) OVER w AS before, count(*) OVER w AS c FROM documents WHERE doc_id % 3 <> 1 WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
         broken AS (SELECT min(doc_id) AS first FROM d WHERE c > 0 AND before + greatest(1, before // c) > (SELECT sum(n_chars) // 4 FROM documents))
       SELECT doc_id, g AS field_group, CASE WHEN doc_id >= coalesce((SELECT first FROM broken), 9223372036854775807) THEN 'skipped' WHEN g = 'code' THEN 'success' ELSE 'pending_agent' END AS status,
         CASE WHEN doc_id >= coalesce((SELECT first FROM broken), 9223372036854775807) THEN 'token budget exceeded' END AS error
       FROM d, (VALUES ('code'), ('summaries')) v(g) WHERE g = 'code' OR doc_id < coalesce((SELECT first FROM broken), 9223372036854775807)"""
)
def enrich_budget(spark, sf_dir):
    """Enrichment under a token budget: documents beyond it get one skipped result, for the first group they asked for."""
    from pagemill.plans.enrich import enrich_within_budget

    docs = table(spark, sf_dir, "documents")
    budget = docs.agg(F.expr("sum(n_chars) div 4")).first()[0]
    asked = docs.where("doc_id % 3 <> 1").select(
        "doc_id", "n_chars", F.create_map(F.lit("plain_text"), F.col("text"), F.lit("language"), F.coalesce("lang", F.lit("x"))).alias("fields"),
        F.array(F.lit("code"), F.lit("summaries")).alias("field_groups"),
    )
    return enrich_within_budget(asked, E.builtin_groups(spark), ["doc_id"], "n_chars", budget).select("doc_id", "field_group", "status", "error")


@query(
    """SELECT doc_id, 'summaries' AS field_group, 'Sum up ' || source || ':' || chr(10) || '* plain_text = ' || text || chr(10) || '* title = ' || source || chr(10) || '* headline = CHIEF_' || source AS head, NULL AS evidence FROM documents
       UNION ALL SELECT doc_id, 'code', NULL, 'passthrough|source_field:language' FROM documents
       UNION ALL SELECT doc_id, 'standardized_job_title', NULL, 'lookup|lookup:Chief ' || source FROM documents"""
)
def group_templates(spark, sf_dir):
    """Field groups with a prompt template of their own, given as data, and the evidence of those answered without a model."""
    fields = F.create_map(F.lit("plain_text"), F.col("text"), F.lit("title"), F.col("source"), F.lit("language"), F.lit("x"), F.lit("headline"), F.concat(F.lit("CHIEF_"), F.col("source")))
    docs = table(spark, sf_dir, "documents")
    asked = docs.select("doc_id", fields.alias("fields"), F.array(*[F.lit(g) for g in ("summaries", "code", "standardized_job_title")]).alias("field_groups"))
    template = "Sum up {{ source_fields.get('title') }}:\n{% for k, v in source_fields.items() %}* {{ k }} = {{ v }}\n{% endfor %}"
    titles = docs.select("source").distinct().select(
        F.concat(F.lit("Chief "), F.col("source")).alias("key"), F.xxhash64("source").alias("ord"), F.create_map(F.lit("value"), F.col("source")).alias("values")
    )
    out = E.run_groups(asked, E.with_templates(E.builtin_groups(spark), {"summaries": template}), titles)
    return out.select("doc_id", "field_group", F.col("agent_prompt").alias("head"), F.concat_ws("|", "source_type", F.array_join("evidence", ",")).alias("e")).select(
        "doc_id", "field_group", "head", F.when(F.col("e") != "", F.col("e")).alias("evidence")
    )
