import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pagemill import cli
from pagemill.operators import enrich as E
from pagemill.operators import export as X
from pagemill.plans import crawl as PC
from pagemill.plans import enrich as PE
from pagemill.sinks import files as K
from pagemill.sources import documents as D
from pagemill.sources import files as S
from pagemill.streaming.crawl import crawl_stream, page_stream

LONG = "<article><h1>Head</h1><p>" + "some words of content " * 20 + "</p></article>"
ATOM = (
    '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A  paper</title><summary>Its summary.</summary>'
    "<author><name>Ann Lee</name></author></entry></feed>"
)


@pytest.fixture(scope="module")
def fetched(spark):
    rows = [
        (1, "http://e.example/a?x=1", LONG, None, "text/html", "generic", "page"),
        (2, "http://e.example/a#y", LONG, None, "text/html", "generic", "page"),
        (3, "http://e.example/short", "<p>x</p>", None, "text/html", "generic", "page"),
        (4, "http://e.example/api", None, '{"name":"N","summary":"S","n":3,"deep":{"a":1}}', "application/json", "generic", "page"),
        (5, "https://arxiv.org/abs/2101.00001", ATOM, None, "application/atom+xml", "arxiv", "paper"),
    ]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, json_data string, content_type string, platform string, resource_type string"
    )


def test_crawl_routes_every_format_and_keeps_errors(spark, fetched):
    rows = {r.canonical_url: r for r in PC.crawl_records(fetched).collect()}
    assert len(rows) == 4
    assert rows["http://e.example/short"].error_code == "CONTENT_EMPTY" and rows["http://e.example/short"].retryable
    assert rows["http://e.example/a"].total_chunks == 1 and rows["http://e.example/a"].status == "success"
    api = rows["http://e.example/api"]
    assert api.title == "N" and api.plain_text == "N\nS\nn: 3" and api.chunking_strategy == "json_structured"
    paper = rows["https://arxiv.org/abs/2101.00001"]
    assert paper.title == "A paper" and paper.plain_text == "A paper\nAbstract\nIts summary."


def test_crawl_skips_completed_addresses(spark, fetched):
    done = spark.createDataFrame([("http://e.example/a",)], "canonical_url string")
    assert "http://e.example/a" not in {r.canonical_url for r in PC.crawl_records(fetched, done).collect()}


def test_run_outputs(spark, fetched, tmp_path):
    root = str(tmp_path / "run")
    K.write_run(PC.crawl_records(fetched).drop("sections", "chunks"), root)
    summary = json.loads("\n".join(r.value for r in spark.read.text(f"{root}/summary.json").collect()))
    assert summary["status"] == "partial_success" and summary["records_total"] == 4
    assert spark.read.json(f"{root}/dlq.jsonl").count() == 1


def test_jsonl_source(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('﻿{"platform":"arxiv","n":1}\n\n  \n{"platform":"base"}\n', encoding="utf-8")
    rows = S.read_records(spark, str(path)).collect()
    assert [r.record["platform"] for r in rows] == ["arxiv", "base"]
    path.write_text('{"a":1}\n{bad\n', encoding="utf-8")
    with pytest.raises(Exception):
        S.read_jsonl(spark, str(path)).collect()


def test_submission_without_url_fails_or_is_left_out(spark):
    rows = spark.createDataFrame(
        [("", "", "t", "", "", "{}", "2026"), ("http://u", "", "t", "", "", None, "")],
        "canonical_url string, url string, plain_text string, cleaned_data string, markdown string, structured string, crawl_timestamp string",
    )
    with pytest.raises(Exception, match="missing canonical_url"):
        X.submission_entries(rows, "d", F.lit("2025")).collect()
    kept = X.submission_entries(rows, "d", F.lit("2025"), strict=False).collect()
    assert [(r.url, r.crawl_timestamp, r.structured_data) for r in kept] == [("http://u", "2025", "{}")]


def test_requests_are_bounded_and_whole(spark):
    rows = spark.range(1000).select(
        F.lit("d").alias("dataset_id"), F.concat(F.lit("u"), "id").alias("url"), F.lit("").alias("cleaned_data"),
        F.lit("{}").alias("structured_data"), F.lit("t").alias("crawl_timestamp"),
    )
    sizes = [r.n for r in X.submission_requests(rows, 50).select(F.size("entries").alias("n")).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 50


def test_enrichment_state_machine_and_answers(spark, tmp_path):
    records = spark.createDataFrame(
        [("http://x/1", "generic", "page", "I use Python and Rust daily", "Senior-Engineer", '{"repo":"r"}')],
        "canonical_url string, platform string, resource_type string, plain_text string, headline string, structured string",
    )
    titles = spark.createDataFrame(
        [("Senior Engineer", 0, {"standardized_job_title": "Engineers", "seniority_level": "senior"})],
        "key string, ord int, values map<string,string>",
    )
    asked = ["skills_extraction", "standardized_job_title", "code", "about_summary", "summaries", "none_such"]
    results = PE.enrich_records(records, E.builtin_groups(spark), titles, asked).persist()
    rows = {r.field_group: r for r in results.collect()}
    assert rows["skills_extraction"].status == "success" and rows["skills_extraction"].values["skills_extracted"] == "Python,Rust"
    assert rows["skills_extraction"].values["skill_categories"] == "programming_language"
    assert rows["standardized_job_title"].confidence == 0.85
    assert rows["standardized_job_title"].values["seniority_level"] == "senior"
    assert rows["code"].values == {"code_signal": "r"} and rows["code"].confidence == 0.6
    assert rows["about_summary"].status == "skipped" and "missing required" in rows["about_summary"].error
    assert rows["none_such"].error == "unknown field group: none_such"
    pending = rows["summaries"]
    assert pending.status == "pending_agent" and "plain_text: I use Python" in pending.agent_prompt

    path = tmp_path / "answers.json"
    path.write_text(json.dumps({f"{pending.doc_id}:summaries": '{"summary":"short"}'}), encoding="utf-8")
    filled = PE.fill(results, S.read_responses(spark, str(path))).filter("field_group = 'summaries'").first()
    assert filled.status == "success" and filled.values == {"summary": "short"} and filled.confidence == 0.8
    assert E.cacheable(results).filter("status = 'pending_agent'").count() == 0


def test_caller_supplied_model(spark):
    import pandas as pd

    def complete(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: json.dumps({"summary": p[:5]}))

    rows = spark.createDataFrame(
        [("d", "summaries", "pending_agent", "hello there", ["summary"], None, None), ("d", "code", "success", None, None, {"a": "b"}, 0.6)],
        "doc_id string, field_group string, status string, agent_prompt string, output_fields array<string>, values map<string,string>, confidence double",
    )
    out = PE.fill(rows, PE.answer_pending(rows, complete)).collect()
    assert {r.field_group: r.values for r in out} == {"summaries": {"summary": "hello"}, "code": {"a": "b"}}


def test_lookup_prefix_rules(spark):
    keys = ["Data Scientist", "Data Scientist Lead", "Dat", "Manager"]
    dictionary = spark.createDataFrame(list(enumerate(keys)), "ord int, key string")
    values = ["Data Scientist", "data_scientist", "Data Scientist Lead II", "Data Sci", "Manager of x", "Dat", "Da", "zzz", " ", None]
    out = E.lookup(spark.createDataFrame([(v,) for v in values], "v string"), "v", dictionary)
    got = {r.v: (r.match_key, round(r.confidence, 6)) for r in out.collect()}

    def norm(s):
        return s.strip().lower().replace("-", " ").replace("_", " ")

    def model(v):
        if v is None or not v.strip():
            return (None, 0.0)
        if v.strip() in keys:
            return (v.strip(), 1.0)
        q = norm(v)
        same = [k for k in keys if norm(k) == q]
        if same:
            return (same[-1], 0.85)
        best, size = None, 0
        for k in keys:
            if q.startswith(norm(k)) or norm(k).startswith(q):
                over = min(len(q), len(norm(k)))
                if over > size and over >= 4:
                    best, size = k, over
        return (best, round(min(size / len(q) * 0.8, 0.75), 6)) if best else (None, 0.0)

    assert got == {v: model(v) for v in values}


def test_document_types(spark):
    row = spark.range(1).select(
        D.is_document_type(F.lit("Application/PDF; x")).alias("a"), D.is_html_type(F.lit(None).cast("string")).alias("b")
    ).first()
    assert row.a and row.b
    files = spark.createDataFrame([("x.pdf", bytearray(b"%PDF-1.4"))], "path string, content binary")
    try:
        import pypdf  # noqa: F401
    except ImportError:
        assert D.document_pages(files).first().skipped == "parser_not_installed"


def test_crawl_stream_appends_and_skips_what_is_done(spark, tmp_path):
    src, root, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    schema = "page_id long, url string, html string"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        crawl_stream(page_stream(spark, src), root, ckpt).awaitTermination(120)

    add((1, "http://e/a", LONG), (2, "http://e/b", "x"))
    run()
    add((3, "http://e/a?again", LONG), (4, "http://e/c", LONG))
    run()
    assert sorted(r.canonical_url for r in spark.read.json(f"{root}/records").collect()) == ["http://e/a", "http://e/c"]
    assert spark.read.json(f"{root}/errors").count() == 1


def test_crawl_stream_batch_that_runs_again_makes_the_same_rows(spark, tmp_path):
    src, root, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rows = [(1, "http://e/a", LONG), (2, "http://e/b", LONG)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(src)
    crawl_stream(page_stream(spark, src), root, ckpt).awaitTermination(120)
    (tmp_path / "ckpt/commits/0").unlink()
    (tmp_path / "ckpt/commits/.0.crc").unlink(missing_ok=True)
    crawl_stream(page_stream(spark, src), root, ckpt).awaitTermination(120)
    assert sorted(r.canonical_url for r in spark.read.json(f"{root}/records").collect()) == ["http://e/a", "http://e/b"]


def test_command_line(spark, fetched, tmp_path):
    pages, out = str(tmp_path / "pages"), str(tmp_path / "out")
    fetched.select("page_id", "url", "html").filter("page_id < 4").write.parquet(pages)
    assert cli.main(["crawl", "--input", pages, "--output", out]) == 0
    assert cli.main(["crawl", "--input", pages, "--output", out, "--strict"]) == 1
    assert spark.read.json(f"{out}/records.jsonl").count() == 1
    seeds = tmp_path / "seeds.jsonl"
    seeds.write_text('{"platform":"generic","resource_type":"page","url":"http://e.example/a?x=1"}\n', encoding="utf-8")
    assert cli.main(["discover-crawl", "--input", str(seeds), "--pages", pages, "--output", str(tmp_path / "d")]) == 0
    assert spark.read.json(str(tmp_path / "d/records.jsonl")).count() == 1


def test_frequent_lookups_are_joined_in_parts(spark, monkeypatch):
    """The rows of a frequent value and the texts of a group don't meet in one task, and none is lost."""
    from pagemill.operators import enrich as E

    monkeypatch.setattr(E, "PART_ROWS", 7)
    rows = spark.createDataFrame([(i, "Boss" if i % 10 else f"boss-{i}" if i % 20 else None, {"k": "v"}) for i in range(200)], "i long, v string, m map<string,string>")
    words = spark.createDataFrame([("Boss", 1, "x"), ("none", 2, "y")], "key string, ord int, more string")
    out = E.lookup(rows, "v", words, entry={"more": "held"})
    got = {r.i: (r.match_key, r.held, r.confidence) for r in out.collect()}
    assert out.count() == 200 and all(got[i] == ("Boss", "x", 1.0) for i in range(200) if i % 10)
    assert got[0] == (None, None, 0.0) and got[10][:2] == ("Boss", "x")
    assert "_part" in out._jdf.queryExecution().optimizedPlan().toString()
    docs = rows.select(F.col("i").alias("doc_id"), F.create_map(F.lit("headline"), F.col("v")).alias("fields"), F.array(F.lit("code"), F.lit("nope")).alias("field_groups"))
    plan = E.run_groups(docs, E.builtin_groups(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan


def test_words_are_weighed_as_texts_are(spark):
    from pagemill.functions import text as T

    texts = ["go GO Rust, x", "\u4e00\u4e8c kotlin\u3000a", "", " \t", "caf\u00e9 \u4e00x \u3005 \U00020000"]
    words = spark.createDataFrame([(t,) for t in texts], "t string").select(F.explode(F.filter(F.split("t", T.SPACE, -1), lambda w: w != "")).alias("w"))
    assert all(r.a == r.b for r in words.select(T.token_estimate(F.col("w")).alias("a"), T.word_tokens(F.col("w")).alias("b")).collect())
    assert [r.n for r in words.where("w = '\u4e00\u4e8c'").select(T.word_tokens(F.col("w")).alias("n")).collect()] == [3]
