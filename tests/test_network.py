"""JSON rows, payload merge, platform traversal, expansion and nested prices against plain Python models."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions import json_rows as R
from pagemill.functions import payloads as J
from pagemill.operators import expand as E
from pagemill.operators import traverse as V
from pagemill.operators.merge import merged_payloads


def documents(n=60):
    r = random.Random(3)

    def value(depth):
        pick = r.random()
        if depth > 3 or pick < 0.4:
            return r.choice([1, 2.5, "x", "", " y ", True, None, "$9"])
        if pick < 0.6:
            return [value(depth + 1) for _ in range(r.randint(0, 3))]
        names = ("a", "price", "displayPrice", "priceToPay", "dealPrice", "included", "elements", "colorToAsin", "k/~")
        return {k: value(depth + 1) for k in r.sample(names, r.randint(0, 4))}

    return [json.dumps({"top": value(0), "price": r.choice([None, "3"])}) for _ in range(n)]


def outermost_price(text):
    """Objects in breadth of the document order: each before what it holds, paths of an object in the fixed order."""

    def objects(node):
        if isinstance(node, dict):
            yield node
        for child in node.values() if isinstance(node, dict) else node if isinstance(node, list) else ():
            yield from objects(child)

    for node in objects(json.loads(text)):
        for path in J.PRICE_PATHS:
            found = node
            for key in path:
                found = found.get(key) if isinstance(found, dict) else None
            if isinstance(found, (str, int, float)) and not isinstance(found, bool) and str(found).strip():
                return str(found).strip()
    return None


def test_prices_and_listed_objects(spark):
    texts = documents()
    rows = spark.createDataFrame([(t,) for t in texts], "d string")
    got = rows.select("d", J.embedded_price(F.array("d")).alias("p"), J.graph_items(F.col("d")).alias("items")).collect()
    for r in got:
        assert r.p == outermost_price(r.d)
        count = r.d.count('{"')
        assert all(isinstance(json.loads(x), dict) for x in r["items"]) and len(r["items"]) <= count
    payload = '{"elements":[{"n":2},5],"x":{"included":[{"n":3}]},"included":[{"n":1,"elements":[{"n":4}]}]}'
    items = spark.range(1).select(J.graph_items(F.lit(payload)).alias("i")).first().i
    assert [json.loads(x)["n"] for x in items] == [1, 2, 3, 4]
    none = spark.createDataFrame([(None,), ("no JSON",)], "d string").select(J.graph_items(F.col("d")).alias("i")).collect()
    assert [r.i for r in none] == [[], []]


def model_pointer(document, pointer):
    if not pointer.startswith("/"):
        return None
    for step in pointer[1:].split("/"):
        step = step.replace("~1", "/").replace("~0", "~")
        if isinstance(document, list):
            if not step.isdigit() or int(step) >= len(document):
                return None
            document = document[int(step)]
        elif isinstance(document, dict) and step in document:
            document = document[step]
        else:
            return None
    return json.dumps(document, separators=(",", ":"), sort_keys=True)


def test_pointers(spark):
    pointers = ["", "/", "x", "/top", "/price", "/top/0", "/top/1/a", "/top/k~1~0", "/top/included/0/price", "/top/00", "/top/-1"]
    rows = [(d, p) for d in documents(25) for p in pointers]
    got = spark.createDataFrame(rows, "d string, p string").select("d", "p", R.value_at_pointer(F.col("d"), F.col("p")).alias("v")).collect()
    for r in got:
        shown = None if r.v is None else json.dumps(json.loads(r.v), separators=(",", ":"), sort_keys=True)
        assert shown == model_pointer(json.loads(r.d), r.p)


def model_merge(payloads):
    out, data, included, elements = {}, {}, [], []
    for p in payloads:
        if not isinstance(p, dict):
            continue
        out.update({k: v for k, v in p.items() if k not in ("included", "data")})
        included += [x for x in p.get("included") or [] if isinstance(x, dict)] if isinstance(p.get("included"), list) else []
        if isinstance(p.get("data"), dict):
            data.update({k: v for k, v in p["data"].items() if k != "elements"})
            if isinstance(p["data"].get("elements"), list):
                elements += [x for x in p["data"]["elements"] if isinstance(x, dict)]
    if elements:
        data["elements"] = elements
    return {**out, **({"data": data} if data else {}), **({"included": included} if included else {})}


def test_merged_payloads(spark):
    r = random.Random(4)
    rows = []
    for k in (1, 2, None):
        for order in range(6):
            body = {"a": r.choice([1, "1", None, {"x": 1}]), f"k\"{order % 2}": order, "included": r.choice([[{"i": order}, 4], 7, []])}
            body["data"] = r.choice([{"elements": [{"e": order}], "y": order}, {"y": [order]}, 3, {}])
            rows.append((k, order, r.choice([json.dumps(body), json.dumps(body), "broken", "[1]"])))
    rows += [(4, 0, None), (1, None, '{"a":"earliest","z":0}')]
    got = {x.rec: x.payload for x in merged_payloads(spark.createDataFrame(rows, "rec long, ord int, payload string").repartition(3), ["rec"], "ord").collect()}
    assert set(got) == {1, 2, 4, None}
    for k, text in got.items():
        own = sorted((x for x in rows if x[0] == k), key=lambda x: (x[1] is not None, x[1] or 0))
        parsed = [json.loads(x[2]) if x[2] and x[2] != "broken" else None for x in own]
        assert json.loads(text) == model_merge(parsed)
    empty = spark.createDataFrame([], "rec long, ord int, payload string")
    assert merged_payloads(empty, ["rec"], "ord").count() == 0


def test_references_in_targets_and_texts(spark):
    html = """<A data-x='a>b' HREF=' /x?a=1&amp;b=&#x26;&#233; '>T&eacute;xt <b>&lt;b&gt;</b></a><a href="">no</a><a name=x>no</a><!-- <a href=/c> -->
    <script>'<a href="/s">'</script><a href=/u&amp;lt;>&nosuch; &amp;lt;</a>"""
    row = spark.range(1).select(H.bare_anchors(F.lit(html)).alias("a"), H.anchor_targets(F.lit(html)).alias("t")).first()
    assert [(a.href, a.text) for a in row.a] == [("/x?a=1&b=&é", "Téxt <b>"), ("/u&lt;", "&nosuch; &lt;")]
    assert row.t == [a.href for a in row.a]
    long = "<a " + "x" * 200_000 + "<a href='/y'>" + "z" * 200_000
    assert spark.range(1).select(H.anchor_targets(F.lit(long)).alias("t")).first().t == ["/y"]


@pytest.fixture(scope="module")
def site(spark):
    pages = [
        ("wikipedia", "https://en.wikipedia.org/wiki/A", '<a href="/wiki/B">b</a><a href="/wiki/B">b</a><a href="/wiki/Talk:B">t</a><a href="/wiki/C">c</a>'),
        ("wikipedia", "https://en.wikipedia.org/wiki/B", '<a href="/wiki/A">a</a><a href="/wiki/D">d</a>'),
        ("wikipedia", "https://de.wikipedia.org/wiki/Z", '<a href="/wiki/A">a</a>'),
        ("arxiv", "https://arxiv.org/abs/2101.00001", '<a href="/abs/2101.00002v3">p</a> /abs/2101.00002'),
        ("arxiv", "https://arxiv.org/abs/2101.00002", None),
        ("base", "https://basescan.org/address/0x" + "a" * 40, '<a href="https://basescan.org/tx/0x' + "b" * 64 + '">t</a>'),
        ("other", "http://o.example.com/", '<a href="/x">x</a><a href="mailto:a@b">m</a>'),
    ]
    return spark.createDataFrame(pages, "platform string, url string, html string")


def test_traversal_by_platform(spark, site):
    seeds = site.select("platform", F.col("url").alias("canonical_url"), F.lit("seed").alias("resource_type"), F.lit(0).alias("ord")).where("url not like '%/B' and url not like '%0002'")
    records, errors = V.traverse(seeds, site, 2)
    got = {(r.platform, r.canonical_url.rsplit("/", 1)[1], r.hop_depth) for r in records.collect()}
    assert ("wikipedia", "B", 1) in got and ("arxiv", "2101.00002", 1) in got and ("wikipedia", "A", 0) in got
    assert len(got) == 7
    failed = {(r.platform, r.canonical_url.rsplit("/", 1)[1], r.hop_depth, r.error_code) for r in errors.collect()}
    assert ("wikipedia", "C", 1, "DISCOVERY_CRAWL_FAILED") in failed and ("wikipedia", "D", 2, "DISCOVERY_CRAWL_FAILED") in failed
    assert ("other", "x", 1, "DISCOVERY_CRAWL_FAILED") in failed and len(failed) == 4
    seen = spark.createDataFrame([("wikipedia", "https://en.wikipedia.org/wiki/B")], "platform string, canonical_url string")
    again, _ = V.traverse(seeds, site, 2, visited=seen)
    assert "https://en.wikipedia.org/wiki/B" not in {r.canonical_url for r in again.collect()}
    nothing, errors = V.traverse(seeds.limit(0), site.limit(0), 2)
    assert nothing.count() == errors.count() == 0


def test_expansion_follows_five_searches(spark):
    company = "https://www.linkedin.com/company/acme/"
    found = [f"https://www.linkedin.com/jobs/search/?currentJobId={100000 + i}" for i in range(7)]
    pages = [(company, "".join(f'<a href="{u}">s</a>' for u in found)), (company + "people/", '<a href="/in/ann/">a</a>')]
    pages += [(u, f'<a href="/company/c{i}/">c</a>') for i, u in enumerate(found)] + [(None, "x")]
    urls, summary = E.expand_entities(
        spark.createDataFrame([(company,), (company,), (None,), ("https://www.linkedin.com/in/gone/",), ("http://x.example.com/",)], "url string"),
        spark.createDataFrame(pages, "url string, html string"),
    )
    rows = {r.candidate: r for r in summary.collect()}
    assert len(rows) == 3 and rows[company].search_pages == 5 and rows[company].pages == 7
    assert rows[company].job_ids.split(",") == [str(100000 + i) for i in range(7)]
    assert rows["https://www.linkedin.com/in/gone/"].error == "page_missing" and rows["http://x.example.com/"].error == "not_expandable"
    got = sorted((r.place, r.url, r.bucket) for r in urls.collect())
    assert [u for _, u, b in got if b == "company"] == [f"https://www.linkedin.com/company/c{i}/" for i in range(5)]
    assert [b for _, _, b in got].count("job") == 7 and got[0][1] == found[0]


def test_lengths_of_subtrees_are_differences(spark):
    r = random.Random(9)

    def markup(depth):
        inner = "".join(markup(depth + 1) if depth < 6 and r.random() < 0.6 else f" text {r.randint(0, 9)}  " for _ in range(r.randint(1, 4)))
        tag = r.choice(["div", "p", "section", "nav", "span", "script"])
        return f"<{tag} id=n{depth}>{inner}</{tag}>"

    for html in ["".join(markup(0) for _ in range(8)), "", "<div>a", "<nav><div>x</div></nav><div>y</div>"]:
        rows = H.shred_one(html, "")
        for pre, stop, *_, dropped, size, text_sum, size_sum in rows:
            inside = rows[pre + 1 : stop]
            assert rows[stop - 1][11] - text_sum == sum(len(x[5].strip()) for x in inside if x[5] is not None and not x[9])
            if not dropped:
                assert rows[stop - 1][12] - size_sum + size == sum(x[10] for x in rows[pre:stop] if not x[9])
    deep = "<div>" * 3_000 + "word " * 40 + "</div>" * 3_000
    nodes = spark.createDataFrame([(deep,)], "h string").select(H.shred("h", F.lit("")).alias("n"))
    assert nodes.select(H.main_span(F.col("n")).alias("s")).first().s.selector == "density_analysis"


@pytest.fixture()
def strict_maps(spark):
    """The session default of Spark: a repeated map key is an error."""
    before = spark.conf.get("spark.sql.mapKeyDedupPolicy")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    yield
    spark.conf.set("spark.sql.mapKeyDedupPolicy", before)


def test_records_do_not_need_the_last_win_setting(spark, strict_maps):
    from pagemill.functions.hooks import normalised
    from pagemill.plans.crawl import crawl_records

    payload = json.dumps({"included": [{"$type": "x.JobPosting", "entityUrn": "urn:j:5", "title": "T", "description": "D", "listedAt": 1700000000000}]})
    rows = [("https://www.linkedin.com/jobs/view/5/", "", "linkedin", "job", payload)]
    pages = spark.createDataFrame(rows, "url string, html string, platform string, resource_type string, json_data string")
    held = json.loads(crawl_records(pages, formats=("json",)).first().structured)
    assert (held["source_id"], held["published_at"], held["entity_type"]) == ("5", "2023-11-14T22:13:20Z", "job")

    slots = spark.createDataFrame([([("A", "1", "true", ""), ("B", "2", "true", ""), ("A", "3", "false", "")], [None] * 3)], "s array<struct<asin:string,price:string,available:string,markup:string>>, p array<string>")
    states = slots.select(J.variant_states(F.col("s"), F.col("p")).alias("m")).first().m
    assert {k: tuple(v) for k, v in states.items()} == {"A": ("3", "Unavailable"), "B": ("2", "In Stock")}

    empty = F.create_map().cast("map<string,string>")
    twice = spark.createDataFrame([('{"a": 1, "b": 2, "a": 3}',)], "s string")
    assert twice.select(normalised(F.lit("amazon"), empty, empty, empty, F.lit(""), F.col("s")).alias("n")).first().n == '{"a":3,"b":2}'
