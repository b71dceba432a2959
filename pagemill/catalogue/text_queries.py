"""Whole documents: tokens, noise, repeats, chunks, markdown."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalogue import query, table
from pagemill.functions import text as T
from pagemill.operators import chunk as C
from pagemill.operators import reduce as R
from pagemill.session import spread

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
CJK = r"[\x{4e00}-\x{9fff}\x{3000}-\x{303f}]"


def tokens_sql(text: str) -> str:
    words = f"len(list_filter(regexp_split_to_array({text}, '{WS}'), lambda w: w <> ''))"
    return (
        f"CASE WHEN {text} = '' THEN 0 ELSE greatest(1, {words} + len(regexp_extract_all({text}, '{CJK}'))) END"
    )


def strip_sql(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{WS}', ''), '{WS}$', '')"


NOISE = (
    r"^sign in\b|^sign up\b|^share (this|the) (article|post|page)$|^all rights reserved\.?$|"
    r"^cookie (preferences|policy|settings)$|^accept cookies$|^subscribe( now)?$|^skip to content$"
)


def noise_sql(text: str) -> str:
    flat = f"lower({strip_sql(f'''regexp_replace({text}, '{WS}', ' ', 'g')''')})"
    return f"({flat} = '' OR regexp_matches({flat}, '{NOISE}'))"


LINES = """lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
  unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)"""
PARAS = f"""{LINES}, filled AS (SELECT doc_id, i, {strip_sql('line')} AS p FROM lines),
  paras AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n, p, {tokens_sql('p')} AS tok
    FROM filled WHERE p <> '')"""


@query(f"SELECT doc_id, CAST({tokens_sql('text')} AS INTEGER) AS tokens FROM documents")
def token_estimate(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query(
    f"""SELECT source, lang, count(*) AS docs, CAST(sum({tokens_sql('text')}) AS BIGINT) AS tokens,
        CAST(max({tokens_sql('text')}) AS INTEGER) AS longest FROM documents GROUP BY source, lang"""
)
def tokens_by_source(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("source", "lang", "text")).select(
        "source", "lang", T.token_estimate(F.col("text")).alias("t")
    )
    return docs.groupBy("source", "lang").agg(
        F.count("*").alias("docs"), F.sum("t").alias("tokens"), F.max("t").alias("longest")
    )


@query(
    f"""WITH {LINES} SELECT doc_id, count(*) AS n_lines,
        count(*) FILTER (WHERE {noise_sql('line')}) AS noise_lines FROM lines GROUP BY doc_id"""
)
def noise_lines(spark, sf_dir):
    lines = T.lines(F.col("text"))
    noise = F.size(F.filter(lines, T.is_noise_line)).cast("bigint")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(lines).cast("bigint").alias("n_lines"), noise.alias("noise_lines")
    )


@query(
    f"""WITH {LINES}, k AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id,
          CASE WHEN length(line) >= 24 THEN lower(line) ELSE '#' || i END ORDER BY i) AS rn FROM lines)
        SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n_lines FROM k WHERE rn = 1 GROUP BY doc_id"""
)
def line_dedup_24(spark, sf_dir):
    kept = R.drop_repeats(T.lines(F.col("text")))
    docs = table(spark, sf_dir, "documents").select("doc_id", kept.alias("kept"))
    return docs.select("doc_id", F.array_join("kept", "\n").alias("text"), F.size("kept").cast("bigint").alias("n_lines"))


@query(
    f"""WITH {LINES}, b AS (SELECT doc_id, i, {strip_sql(f"regexp_replace(line, '{WS}', ' ', 'g')")} AS block FROM lines),
        m AS (SELECT doc_id, i, block,
          replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(block,
            '^#{{1,6}}\\s+', ''), '^[-*+]\\s+', ''), '^[0-9]+\\.\\s+', ''), '**', ''), '__', ''), '`', '') AS t
          FROM b WHERE block <> ''),
        s AS (SELECT doc_id, i, block, {strip_sql('t')} AS t FROM m),
        k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, CASE WHEN length(t) >= 24 THEN lower(t) ELSE '#' || i END
          ORDER BY i) AS rn FROM s WHERE NOT {noise_sql('t')})
        SELECT d.doc_id, coalesce(string_agg(t, chr(10) ORDER BY i), '') AS text,
          coalesce(string_agg(block, chr(10) || chr(10) ORDER BY i), '') AS markdown
        FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id AND rn = 1 GROUP BY d.doc_id"""
)
def reduce_text(spark, sf_dir):
    blocks = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    docs = docs.select("doc_id", R.reduce_markdown(blocks).alias("r"))
    return docs.select("doc_id", "r.text", "r.markdown")


def pack_sql(limit: int, overlap: int) -> str:
    """Greedy packing as a recursion over paragraph numbers."""
    back = f"""coalesce((SELECT min(q.n) FROM cum q WHERE q.doc_id = c.doc_id AND q.n >= s.first AND q.n < c.n
        AND c.before - q.before <= {overlap}), c.n)"""
    first = back if overlap else "c.n"
    carried = (
        f"""coalesce((SELECT c.before - min_by(q.before, q.n) FROM cum q WHERE q.doc_id = c.doc_id AND q.n >= s.first
        AND q.n < c.n AND c.before - q.before <= {overlap}), 0)"""
        if overlap
        else "0"
    )
    return f"""WITH RECURSIVE {PARAS},
      cum AS MATERIALIZED (SELECT *, sum(tok) OVER (PARTITION BY doc_id ORDER BY n) - tok AS before FROM paras),
      steps AS (
        SELECT doc_id, n, n AS first, CAST(tok AS HUGEINT) AS total, CAST(NULL AS BIGINT) AS closed FROM cum WHERE n = 1
        UNION ALL
        SELECT c.doc_id, c.n, CASE WHEN s.total + c.tok > {limit} THEN {first} ELSE s.first END,
          CASE WHEN s.total + c.tok > {limit} THEN {carried} + c.tok ELSE s.total + c.tok END,
          CASE WHEN s.total + c.tok > {limit} THEN s.first END
        FROM steps s JOIN cum c ON c.doc_id = s.doc_id AND c.n = s.n + 1),
      spans AS (SELECT doc_id, closed AS first, n - 1 AS last FROM steps WHERE closed IS NOT NULL
        UNION ALL SELECT doc_id, max_by(first, n), max(n) FROM steps GROUP BY doc_id),
      chunks AS (SELECT s.doc_id, row_number() OVER (PARTITION BY s.doc_id ORDER BY s.last) - 1 AS chunk_index,
          s.first, s.last FROM spans s),
      texts AS (SELECT k.doc_id, k.chunk_index, string_agg(p, chr(10) ORDER BY n) AS text
        FROM chunks k JOIN paras USING (doc_id) WHERE n BETWEEN k.first AND k.last GROUP BY ALL)"""


@query(
    f"""{pack_sql(512, 0)} SELECT doc_id, doc_id || '#chunk_' || chunk_index AS chunk_id,
        CAST(chunk_index AS INTEGER) AS chunk_index, text,
        CAST(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY chunk_index) - length(text) AS INTEGER) AS char_offset_start,
        CAST({tokens_sql('text')} AS INTEGER) AS token_count_estimate FROM texts"""
)
def chunk_plain(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = C.explode_chunks(docs.select("doc_id", C.plain_pieces(F.col("text")).alias("p")), "p", "doc_id")
    return rows.select("doc_id", "chunk_id", "chunk_index", "text", "char_offset_start", "token_count_estimate")


@query(f"{pack_sql(128, 40)} SELECT doc_id, CAST(chunk_index AS INTEGER) AS chunk_index, text FROM texts")
def chunk_overlap(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    groups = docs.select("doc_id", C.paragraph_groups(F.col("text"), 128, 40).alias("g"))
    return C.explode_once(groups, "g", "chunk_index", "text")


@query(
    f"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '{WS}'), lambda x: x <> '')) AS w,
          unnest(range(len(list_filter(regexp_split_to_array(text, '{WS}'), lambda x: x <> '')))) AS i FROM documents)
        SELECT doc_id, CAST(i // 64 AS INTEGER) AS segment, string_agg(w, ' ' ORDER BY i) AS text FROM w GROUP BY doc_id, i // 64"""
)
def split_words(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return C.explode_once(docs.select("doc_id", C.word_segments(F.col("text"), 64).alias("g")), "g", "segment", "text")


@query(
    f"""{pack_sql(512, 0)} SELECT source, count(*) AS chunks, CAST(sum(length(text)) AS BIGINT) AS chars,
        CAST(max({tokens_sql('text')}) AS INTEGER) AS largest FROM texts JOIN documents d USING (doc_id) GROUP BY source""".replace(
        "sum(length(text))", "sum(length(texts.text))"
    ).replace("max(CASE WHEN text", "max(CASE WHEN texts.text").replace("(text, '", "(texts.text, '").replace(
        "unnest(string_split(texts.text", "unnest(string_split(text"
    )
)
def chunk_stats(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("source", "text"))
    groups = C.explode_once(docs.select("source", C.paragraph_groups(F.col("text"), 512).alias("g")), "g", "i", "text")
    return groups.groupBy("source").agg(
        F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"), F.max(T.token_estimate(F.col("text"))).alias("largest")
    )


# Markdown made from every document: headings, a repeated title, page numbers, references.
MARKDOWN = """md AS (SELECT doc_id, source, '# Introduction to ' || source || chr(10) || text || chr(10) || 'Page 3' || chr(10)
  || '## Related Work' || chr(10) || 'see https://code.example.com/' || doc_id || ' and (https://data.example.org/' || doc_id || ') now.'
  || chr(10) || chr(10) || chr(10) || chr(10) || '### Results **' || lang || '**' || chr(10) || '- got 2101.' || lpad(CAST(doc_id AS VARCHAR), 5, '0')
  || 'v2, 1999.0001 and 2101.' || lpad(CAST(doc_id AS VARCHAR), 5, '0') || 'v2' || chr(10) || '# References' || chr(10) || '[1] First ' || source
  || chr(10) || 'not a reference' || chr(10) || '2. Second ' || lang || chr(10) AS md FROM documents)"""


def markdown_of(spark, sf_dir):
    doc = F.col("doc_id").cast("string")
    number = F.lpad(doc, 5, "0")
    parts = (
        "# Introduction to ", F.col("source"), "\n", F.col("text"), "\nPage 3\n## Related Work\nsee https://code.example.com/",
        doc, " and (https://data.example.org/", doc, ") now.\n\n\n\n### Results **", F.col("lang"), "**\n- got 2101.", number,
        "v2, 1999.0001 and 2101.", number, "v2\n# References\n[1] First ", F.col("source"), "\nnot a reference\n2. Second ",
        F.col("lang"), "\n",
    )
    md = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return spread(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "text", md.alias("md"))


@query(
    f"""WITH {MARKDOWN} SELECT doc_id, 0 AS pos, 'Introduction to ' || source AS heading,
          left(split_part({strip_sql("(SELECT text FROM documents d WHERE d.doc_id = md.doc_id) || chr(10) || 'Page 3'")}, chr(10), 1), 240) AS content_summary,
          'introduction' AS section_type FROM md
        UNION ALL SELECT doc_id, 1, 'Related Work', 'see https://code.example.com/' || doc_id || ' and (https://data.example.org/' || doc_id || ') now.', 'related_work' FROM md
        UNION ALL SELECT md.doc_id, 2, 'Results **' || lang || '**', '- got 2101.' || lpad(CAST(md.doc_id AS VARCHAR), 5, '0') || 'v2, 1999.0001 and 2101.' || lpad(CAST(md.doc_id AS VARCHAR), 5, '0') || 'v2', 'results'
          FROM md JOIN documents d ON d.doc_id = md.doc_id
        UNION ALL SELECT doc_id, 3, 'References', '[1] First ' || source, 'references' FROM md"""
)
def md_sections(spark, sf_dir):
    rows = markdown_of(spark, sf_dir).select("doc_id", T.markdown_sections(F.col("md"), summary_chars=240).alias("s"))
    return C.explode_once(rows, "s", "pos", "x").select("doc_id", "pos", "x.heading", "x.content_summary", "x.section_type")


@query(
    f"""WITH {MARKDOWN} SELECT md.doc_id, '[1] First ' || md.source || '|2. Second ' || lang AS refs,
        'https://code.example.com/' || md.doc_id || ' https://data.example.org/' || md.doc_id AS urls,
        CASE WHEN md.doc_id < 0 THEN '' ELSE '1999.0001 2101.' || lpad(CAST(md.doc_id AS VARCHAR), 5, '0') || 'v2' END AS paper_ids
        FROM md JOIN documents d ON d.doc_id = md.doc_id"""
)
def references_and_links(spark, sf_dir):
    md = F.col("md")
    return markdown_of(spark, sf_dir).select(
        "doc_id",
        F.array_join(T.reference_lines(md), "|").alias("refs"),
        F.array_join(T.urls_in(md), " ").alias("urls"),
        F.array_join(T.paper_ids_in(md), " ").alias("paper_ids"),
    )


@query(
    f"""WITH {MARKDOWN}, l AS (SELECT doc_id, source, unnest(string_split(md, chr(10))) AS line,
          unnest(range(len(string_split(md, chr(10))))) AS i FROM md),
        r AS (SELECT doc_id, source, i, regexp_replace(line, '{WS}$', '') AS line FROM l),
        t AS (SELECT *, row_number() OVER (PARTITION BY doc_id, {strip_sql('line')} ORDER BY i) AS nth FROM r
          WHERE NOT regexp_matches({strip_sql('line')}, '^Page\\s+[0-9]+$'))
        SELECT doc_id, {strip_sql("regexp_replace(string_agg(line, chr(10) ORDER BY i), '\\n{3,}', chr(10) || chr(10), 'g')")} AS cleaned
        FROM t WHERE nth = 1 OR {strip_sql('line')} <> '# Introduction to ' || source GROUP BY doc_id"""
)
def page_furniture(spark, sf_dir):
    rows = markdown_of(spark, sf_dir)
    title = F.concat(F.lit("# Introduction to "), F.col("source"))
    return rows.select("doc_id", T.drop_page_furniture(F.col("md"), title).alias("cleaned"))


@query(
    """SELECT c_custkey, c_name AS full_name,
         'Customer' || c_custkey AS first_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS last_name,
         'Value of x in ' || c_mktsegment AS latex,
         CASE c_custkey % 4 WHEN 0 THEN 'cs,cs.CL,Natural language processing' WHEN 1 THEN 'stat,stat.ML,Statistical machine learning'
           WHEN 2 THEN 'math,math.AG,math.AG' ELSE '' END AS category_path FROM customer"""
)
def paper_fields(spark, sf_dir):
    key = F.col("c_custkey")
    first = F.concat(F.lit(" Customer"), key.cast("string"))
    name = F.when(key % 3 == 0, first).otherwise(F.concat(first, F.lit("  von \t"), F.col("c_mktsegment"), F.lit(" ")))
    latex = F.concat(F.lit("Value  of ${x}$ in \\textbf{"), F.col("c_mktsegment"), F.lit("}"))
    primary = F.when(key % 4 == 0, F.lit("cs.CL")).when(key % 4 == 1, F.lit("stat.ML"))
    others = F.when(key % 4 == 2, F.array(F.lit("math.AG"))).otherwise(F.array().cast("array<string>"))
    author = T.author_name(name)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("full_name"),
        author["first_name"].alias("first_name"),
        author["last_name"].alias("last_name"),
        T.strip_latex(latex).alias("latex"),
        F.array_join(T.category_path(others, primary), ",").alias("category_path"),
    )
