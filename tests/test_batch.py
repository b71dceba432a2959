"""The batch chain end to end, the result cache, the token budget, templates as data, and errors by rule."""

import pytest
from pyspark.sql import functions as F

from pagemill.functions import errors
from pagemill.operators import cache as C
from pagemill.operators import enrich as E
from pagemill.plans import batch as B
from pagemill.plans import enrich as N


@pytest.fixture(scope="module")
def registry(spark):
    return E.builtin_groups(spark)


def page(title):
    return f"<html><head><title>{title}</title></head><body><article><h1>{title}</h1><p>{'Some words about it. ' * 20}</p></article></body></html>"


def test_batch_chain(spark, registry):
    records = [
        {"platform": "generic", "resource_type": "page", "canonical_url": "http://a.example.com/1", "url": "http://a.example.com/1"},
        {"platform": "generic", "resource_type": "page", "canonical_url": "http://a.example.com/1"},
        {"platform": "wikipedia", "resource_type": "article", "title": "Red fox"},
        {"platform": "generic", "resource_type": "page", "canonical_url": "http://a.example.com/lost"},
        {"platform": "wikipedia", "resource_type": "article"},
        {"platform": "generic", "resource_type": "page", "canonical_url": "http://a.example.com/done"},
    ]
    pages = [("http://a.example.com/1", page("One")), ("http://a.example.com/1", page("Other body")), ("https://en.wikipedia.org/wiki/Red_fox", page("Red fox")), ("http://a.example.com/done", page("Done")), ("http://a.example.com/unasked", page("No"))]
    given = spark.createDataFrame([(r,) for r in records], "record map<string,string>").coalesce(1)
    done = spark.createDataFrame([("http://a.example.com/done",)], "canonical_url string")
    out = B.run_batch(given, spark.createDataFrame(pages, "url string, html string"), registry, "set", F.lit("2026-01-01T00:00:00Z"), done, requested=["summaries"], formats=("html",))
    rows = {r.canonical_url: r for r in out["results"].select("canonical_url", "platform", "title", "status", "error_code", "stage").collect()}
    assert {u: r.status for u, r in rows.items()} == {
        "http://a.example.com/1": "success", "https://en.wikipedia.org/wiki/Red_fox": "success", "http://a.example.com/lost": "failed", None: "failed",
    }
    assert rows["http://a.example.com/1"].title == "One" and rows["https://en.wikipedia.org/wiki/Red_fox"].platform == "wikipedia"
    assert rows["http://a.example.com/lost"].error_code == "PAGE_NOT_FOUND" and rows[None].error_code == "INVALID_INPUT" and rows[None].stage == "discover"
    assert sorted(r.status for r in out["enrichment"].collect()) == ["pending_agent"] * 2
    entries = out["entries"].collect()
    assert {e.url for e in entries} == {"http://a.example.com/1", "https://en.wikipedia.org/wiki/Red_fox"}
    assert all("Some words" in e.cleaned_data and e.crawl_timestamp == "2026-01-01T00:00:00Z" for e in entries)


def test_cache_answers_once(spark, registry, tmp_path):
    texts = ["same", "same", "other", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, plain_text string").select(
        "doc_id", F.map_filter(F.create_map(F.lit("plain_text"), F.col("plain_text")), lambda _, v: v.isNotNull()).alias("fields"), F.array(F.lit("summaries")).alias("field_groups")
    )
    folder = str(tmp_path / "cache")
    first = N.enrich_cached(docs, registry, folder, "b1", lambda prompts: prompts.map(lambda p: '{"summary": "s"}')).collect()
    assert sorted((r.doc_id, r.status, r.reused) for r in first)[:3] == [(0, "success", False), (1, "success", False), (2, "success", False)]
    assert spark.read.parquet(folder).count() == 3
    again = N.enrich_cached(docs.where("doc_id < 3"), registry, folder, "b2", lambda prompts: prompts.map(lambda p: 1 / 0)).collect()
    assert [(r.status, r.reused, list(r["values"].values())) for r in again] == [("success", True, ["s"])] * 3
    # A batch written again replaces itself; a key kept by two batches is read once.
    kept = spark.createDataFrame([("ab" + "0" * 62, "success", {"a": "1"}, 0.5), ("ab" + "1" * 62, "failed", None, 0.0), (None, "success", {}, 1.0)], f"cache_key string, {C.FIELDS}")
    other = str(tmp_path / "other")
    C.add_to_cache(kept, other, "x")
    C.add_to_cache(kept, other, "x2")
    assert C.read_cache(kept.select("cache_key"), other).count() == 1
    assert C.read_cache(kept.select("cache_key").limit(0), other).count() == 0


def test_budget_admits_a_prefix(spark, registry):
    used = [5, 0, 4, 9, 1, 1]
    docs = spark.createDataFrame([(i, u) for i, u in enumerate(used)], "doc_id long, tokens long").select(
        "doc_id", "tokens", F.create_map(F.lit("plain_text"), F.lit("x")).alias("fields"), F.when(F.col("doc_id") != 5, F.array(F.lit("summaries"), F.lit("code"))).otherwise(F.array().cast("array<string>")).alias("field_groups")
    )
    want, consumed, samples, open_ = {}, 0, [], True
    for i, u in enumerate(used):
        if samples and consumed + max(1, sum(samples) // len(samples)) > 14:
            want[i] = "skipped"
            continue
        want[i] = "run"
        consumed += u
        samples += [u] if u > 0 else []
    rows = N.enrich_within_budget(docs, registry, ["doc_id"], "tokens", 14).collect()
    got = {i: {r.error for r in rows if r.doc_id == i} for i in want}
    assert {i for i, w in want.items() if w == "skipped"} == {4, 5}
    assert got[4] == {"token budget exceeded"} and got[5] == set() and all("token budget exceeded" not in got[i] for i in range(4))


def test_templates_as_data_render_like_compiled_ones(spark):
    templates = ["", "plain", "a {{ source_fields.get('x') }} b {{source_fields.get(\"gone\")}}", "{% for k, v in source_fields.items() %}[{{ k }}|{{ v }}|{{ k }}]{% endfor %} end {{ source_fields.get('y') }}"]
    held = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("x", "1"), ("y", "{{ k }}"))])
    for t in templates:
        parts = spark.createDataFrame([(E.template_parts(t),)], f"p array<{E.PART}>")
        row = parts.select(E.render_parts(F.col("p"), held).alias("data"), E.render_template(t, held).alias("compiled")).first()
        assert row.data == row.compiled


def test_errors_by_rule(spark):
    rows = [("http_status", 503, None), ("http_status", 200, "odd"), ("timeout", None, "t"), ("KeyError", 404, "k"), (None, None, None)]
    got = spark.createDataFrame(rows, "exc string, status int, detail string").select(
        "exc", errors.classify(F.col("exc"), F.col("status"), F.col("detail"), F.lit(None).cast("string"), F.lit("u")).alias("e")
    ).collect()
    assert [(r.e.error_code, r.e.message, r.e.status_code) for r in got] == [
        ("SERVER_ERROR", "Server error (503)", 503), ("UNKNOWN_ERROR", "odd", None), ("NETWORK_ERROR", "Request timed out", None),
        ("UNKNOWN_ERROR", "k", None), ("CONTENT_EMPTY", "Page body is empty or too short", None),
    ]
    assert errors.RULES[-1][0] is None


def test_group_routing(spark):
    rows = spark.createDataFrame([("amazon", "seller"), ("amazon", "search"), ("wikipedia", "article"), ("other", "x")], "p string, k string")
    got = [r.g for r in rows.select(N.route_groups(F.col("p"), [], F.col("k")).alias("g")).collect()]
    assert got[0][0] == "amazon_sellers_identity" and len(got[0]) == 6 and got[1] == [] and got[3] == ["summaries"] and len(got[2]) == 3
