import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators import frontier as G
from pagemill.operators import keyed
from pagemill.operators import replay as R


def breaker_model(events, failures=2):
    state, out = {}, {}
    for k, at, eid, kind, pause in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        failed, until = state.get(k, (0, 0))
        if until and at < until:
            out[(k, eid)] = False
            continue
        if until:
            failed, until = 0, 0
        out[(k, eid)] = True
        if kind == R.OK:
            failed = 0
        elif kind == R.TRIP:
            failed += 1
            until = at + pause if failed >= failures else 0
        state[k] = (failed, until)
    return out


def some_events(seed, n=600, hot=0.6):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < hot else f"k{rng.randrange(6)}", 1 + rng.randrange(n), i, rng.choice([0, 1, 1, 1, 2]), rng.choice([3, 9, 40]))
        for i in range(n)
    ]


SCHEMA = "k string, at long, event_id long, kind int, pause long"


@pytest.mark.parametrize("seed,blocks", [(1, 3), (2, 17), (3, 40)])
def test_breaker_split_over_blocks_equals_the_fold(spark, seed, blocks):
    events = some_events(seed)
    rows = spark.createDataFrame(events, SCHEMA)
    out = R.breaker_replay(rows, "k", "at", "event_id", "kind", "pause", blocks=blocks).collect()
    assert {(r.k, r.event_id): r.allowed for r in out} == breaker_model(events)


@pytest.mark.parametrize("failures", [1, 3])
def test_breaker_threshold(spark, failures):
    events = some_events(failures)
    out = R.breaker_replay(spark.createDataFrame(events, SCHEMA), "k", "at", "event_id", "kind", "pause", failures, 9).collect()
    assert {(r.k, r.event_id): r.allowed for r in out} == breaker_model(events, failures)


@pytest.mark.parametrize("burst", [1, 4])
def test_admission_split_over_blocks_equals_the_fold(spark, burst):
    events = some_events(burst)
    out = R.admit_times(
        spark.createDataFrame(events, SCHEMA), ["k"], "at", ["event_id"], F.lit(7).cast("long"), burst, blocks=23
    ).collect()
    expected, empty_at = {}, {}
    for k, at, eid, _, _ in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        empty_at[k] = max(at, empty_at.get(k, at)) + 7
        expected[(k, eid)] = max(at, empty_at[k] - burst * 7)
    assert {(r.k, r.event_id): r.admitted_at for r in out} == expected


def test_budget_gate_matches_sequential_rows(spark):
    rows = spark.createDataFrame([(i, 60) for i in range(3)], "i long, used long")
    assert [r.admitted for r in R.budget_gate(rows, ["i"], "used", 100).orderBy("i").collect()] == [True, False, False]
    rng = random.Random(5)
    used = [rng.choice([0, 5, 50]) for _ in range(300)]
    out = R.budget_gate(spark.createDataFrame(list(enumerate(used)), "i long, used long"), ["i"], "used", 2000, blocks=11)
    spent, samples, expected = 0, [], []
    for u in used:
        ok = not samples or spent + max(1, sum(samples) // len(samples)) <= 2000
        expected.append(ok)
        if ok and u > 0:
            spent += u
            samples.append(u)
    assert [r.admitted for r in out.orderBy("i").collect()] == expected


def test_take_first_is_exact_over_blocks(spark):
    rows = spark.createDataFrame([((i * 7919) % 1000, i) for i in range(3000)], "p long, i long")
    expected = sorted(((i * 7919) % 1000, i) for i in range(3000))[:1234]
    got = R.take_first(rows, ["p", "i"], 1234, small=10).collect()
    assert sorted((r.p, r.i) for r in got) == expected


# --- traversal -----------------------------------------------------------------------------------


def page(url, *hrefs):
    return (url, "".join(f'<a href="{h}">x</a>' for h in hrefs))


SITE = [
    page("http://s.example/", "/a", "/b?x=1", "/a#top", "http://other.example/z", "mailto:x"),
    page("http://s.example/a", "/b", "/c", "/missing"),
    page("http://s.example/b", "/", "/c"),
    page("http://s.example/c", "/d"),
    page("http://s.example/d"),
]


def seeds(spark, *urls):
    return spark.createDataFrame([("generic", u, 1.0, i) for i, u in enumerate(urls)], "platform string, canonical_url string, priority double, ord long")


def test_crawl_depth_errors_and_parents(spark):
    pages = spark.createDataFrame(SITE, "url string, html string")
    records, errors = G.crawl(seeds(spark, "http://s.example/"), pages, max_depth=2, max_pages=None)
    got = {r.canonical_url[len("http://s.example"):]: (r.hop_depth, r.parent_url) for r in records.collect()}
    assert got == {
        "/": (0, None), "/a": (1, "http://s.example/"), "/b": (1, "http://s.example/"), "/c": (2, "http://s.example/a"),
    }
    assert [(r.canonical_url, r.hop_depth) for r in errors.collect()] == [("http://s.example/missing", 2)]


def test_crawl_budget_and_resume(spark):
    pages = spark.createDataFrame(SITE, "url string, html string")
    first, _ = G.crawl(seeds(spark, "http://s.example/"), pages, max_depth=5, max_pages=2)
    assert first.count() == 2
    rest, _ = G.crawl(seeds(spark, "http://s.example/", "http://s.example/b"), pages, max_depth=5, max_pages=None, visited=first)
    assert not {r.canonical_url for r in first.collect()} & {r.canonical_url for r in rest.collect()}


def test_keyed_tables(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 4)], "k string, o int")
    assert sorted(r.o for r in keyed.keep_first(rows, ["k"], ["o"]).collect()) == [1, 3, 4]
    assert [r.o for r in keyed.first_n(rows, 2, [F.col("o").desc()]).collect()] == [4, 3]
    changed = keyed.upsert(rows.dropna(), spark.createDataFrame([("a", 9)], "k string, o int"), ["k"])
    assert [r.o for r in changed.collect()] == [9]


def test_bfs_handles_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 4)], "src long, dst long")
    out = G.bfs_levels(edges, spark.createDataFrame([(1,)], "node long"), 2)
    assert {(r.node, r.depth) for r in out.collect()} == {(1, 0), (2, 1), (3, 2)}
