import json
import random
import time

from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions import page_fields as P
from pagemill.functions import payloads as J
from pagemill.operators import chunk as C
from pagemill.operators import content as K
from pagemill.operators import reduce as R

PAGE = """<html><head><title> T </title></head><body><nav>menu</nav><!-- c -->
<div class="ad-banner">buy</div><div class="ad_banner">kept words</div><div style="display: none">hidden</div>
<main><p>Opening words that are long enough to be the main content of this page.</p>
<h1>One</h1><p>First <b>bold</b> and <a href="/x">link</a>.</p><h2>Two</h2><ul><li>item a</li><li>item b</li></ul>
<p>This paragraph is repeated word for word here.</p><p>This paragraph is repeated word for word HERE.</p>
<h3>Three</h3><p>deep</p><h2>Four</h2><p>Subscribe</p><p>last</p></main><footer>foot</footer></body></html>"""


def extract(spark, html, **extra):
    rows = spark.createDataFrame([(1, "http://e.example/p", html)], "page_id long, url string, html string")
    for name, value in extra.items():
        rows = rows.withColumn(name, F.lit(value))
    return K.extract_pages(rows).first()


def test_noise_sections_and_markdown(spark):
    row = extract(spark, PAGE)
    assert row.selector_used == "fallback:semantic:main"
    paths = [(s.heading_text, s.heading_level, list(s.section_path)) for s in row.sections]
    assert paths == [
        (None, None, []), ("One", 1, ["One"]), ("Two", 2, ["One", "Two"]), ("Three", 3, ["One", "Two", "Three"]),
        ("Four", 2, ["One", "Four"]),
    ]
    text = row.plain_text
    for gone in ("menu", "buy", "hidden", "foot", "HERE", "Subscribe"):
        assert gone not in text
    four = row.sections[-1]
    assert four.text == "last" and four.markdown == "## Four\n\nlast"
    assert "First **bold** and [link](/x) ." in row.markdown and "- item a" in row.markdown
    # A heading owns what follows it up to the next one of its level, deeper headings included.
    assert "deep" in row.sections[2].text and "last" not in row.sections[2].text


def test_density_and_body_fallback(spark):
    long = "word " * 60
    dense = extract(spark, f"<body><div id=a>short</div><div id=b><p>{long}</p></div></body>")
    assert dense.selector_used == "fallback:density_analysis" and dense.plain_text == long.strip()
    assert extract(spark, "<body>tiny</body>").selector_used == "fallback:fallback:body"
    assert extract(spark, "no tags").selector_used == "fallback:fallback:full_document"


def test_platform_selector(spark):
    html = '<div id="content">no</div><div id="abs">the abstract</div><div class="extra-services">x</div>'
    row = extract(spark, html, platform="arxiv", resource_type="paper")
    assert row.plain_text == "the abstract" and row.selector_used == "fallback:platform:#abs"


def test_selectors(spark):
    html = '<div class="a b" id="i"><p data-k="v1">x</p></div><section><p>y</p></section><p data-k="zz">z</p>'
    rows = spark.createDataFrame([(html,)], "h string").select(H.shred("h", F.lit("")).alias("n"))

    def found(selector):
        texts = F.transform(H.matching(F.col("n"), selector), lambda x: H.text_of(F.col("n"), x))
        return rows.select(texts.alias("t")).first().t

    assert found(".a p") == ["x"] and found("section p, #i p") == ["x", "y"]
    assert found("p[data-k]") == ["x", "z"] and found("[data-k='zz']") == ["z"] and found("p[data-k*='v']") == ["x"]
    assert found("div.b#i") == ["x"] and found("ul li") == []


def test_search_results_and_meta(spark):
    html = '<meta property="og:title" content="Amazon"><title>Real</title>'
    rows = spark.createDataFrame([(html,)], "h string").select(H.shred("h", F.lit("")).alias("n"))
    meta = rows.select(P.page_meta(F.col("n"), F.lit("https://www.amazon.com/dp/B000000000")).alias("m")).first().m
    assert meta.title == "Real" and meta.field_sources["title"] == "html_meta:title"


def test_embedded_product_json(spark):
    script = """x.parseJSON('{"a":[{"priceToPay":{"price":"$5"}}],"colorToAsin":{"Red":{"asin":"B1"},"Blue":"B2"}}') parseJSON('{bad}')"""
    objects = J.embedded_objects(F.lit(script))
    bodies = F.array(F.lit('{"ASIN":"B1","Value":{"content":{"twisterSlotJson":{"price":"9","isAvailable":false}}}}&&&{oops'))
    rows = spark.range(1).select(objects.alias("o"), J.variant_slots(bodies).alias("v")).withColumn("p", P.slot_prices(F.col("v")))
    rows = rows.select("o", J.variant_states(F.col("v"), F.col("p")).alias("s"))
    row = rows.select(J.embedded_price("o").alias("p"), J.embedded_variants("o").alias("v"), "s").first()
    assert row.p == "$5" and [(v.asin, v.label) for v in row.v] == [("B1", "Red"), ("B2", "Blue")]
    assert (row.s["B1"].price, row.s["B1"].availability) == ("9", "Unavailable")


# --- chunking, against a plain model of the rule -------------------------------------------------


def tokens(text):
    return 0 if not text else max(1, len(text.split()) + sum("一" <= c <= "鿿" or "　" <= c <= "〿" for c in text))


def model(sections, most, least, overlap):
    out = []
    for text, path in sections:
        if not text.strip():
            continue
        if tokens(text) <= most:
            out.append([text, path, tokens(text)])
            continue
        parts = [p.strip() for p in text.split("\n") if p.strip()]
        if len(parts) == 1:
            words, parts, now, n = parts[0].split(), [], [], 0
            for w in words:
                if now and n + tokens(w) > most:
                    parts.append(" ".join(now))
                    now, n = [], 0
                now.append(w)
                n += tokens(w)
            parts.append(" ".join(now))
        now, n = [], 0
        for part in parts:
            if now and n + tokens(part) > most:
                out.append(["\n".join(now), path, tokens("\n".join(now))])
                keep, kept = [], 0
                for back in reversed(now):
                    if kept + tokens(back) > overlap:
                        break
                    keep.insert(0, back)
                    kept += tokens(back)
                now, n = keep, kept
            now.append(part)
            n += tokens(part)
        out.append(["\n".join(now), path, tokens("\n".join(now))])
    merged = []
    for text, path, n in out:
        last = merged[-1] if merged else None
        if last and n < least and last[2] + n <= most and last[1] == path:
            last[0], last[2] = last[0] + "\n" + text, last[2] + n
        else:
            merged.append([text, path, n])
    return [(t, n) for t, _, n in merged]


def test_section_chunks_follow_the_model_on_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = F.transform(F.split("text", "\n"), lambda x: R.section(x, x, path=F.array(F.left(x, F.lit(1)))))
    pieces = C.section_pieces(own, 40, 15, 12)
    for row in docs.select("text", pieces.alias("p")).collect():
        sections = [(s, s[:1]) for s in row.text.split("\n")]
        assert [(p.text, p.token_count_estimate) for p in row.p] == model(sections, 40, 15, 12)


def test_large_sections_split_with_overlap(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = C.section_pieces(F.array(R.section(F.col("text"), F.col("text"))), 60, 20, 25)
    for row in docs.select("text", pieces.alias("p")).collect():
        assert [(p.text, p.token_count_estimate) for p in row.p] == model([(row.text, "")], 60, 20, 25)


def test_reduction_is_idempotent(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    once = R.reduce_markdown(F.replace("text", F.lit("\n"), F.lit("\n\n")))
    rows = docs.select(once.alias("a")).select("a", R.reduce_markdown(F.col("a.markdown")).alias("b"))
    assert rows.filter(F.col("a.text") != F.col("b.text")).count() == 0


def test_section_offsets_leave_two_characters(spark):
    s = F.array(R.section(F.lit("x"), F.lit("alpha\n\n# beta")), R.section(F.lit("y"), F.lit("Sign in")), R.section(F.lit("z"), F.lit("gamma")))
    out = spark.range(1).select(R.reduce_sections(s).alias("s")).first().s
    assert [(r.text, r.char_offset_start, r.char_offset_end) for r in out] == [("alpha\nbeta", 0, 10), ("gamma", 12, 17)]


def test_results_of_a_batch_are_handed_back_in_pieces():
    import pyarrow as pa

    from pagemill.functions import json_rows as R
    from pagemill.functions.batches import PIECE_BYTES
    from pagemill.operators.alias import flatten_json

    page = "<p>x</p>" * (PIECE_BYTES // 32)
    pages = pa.array([page] * 9 + [None, page * 9, ""])
    made = list(H.shred.func(iter([(pages, pa.array(["generic"] * 12))])))
    assert [len(a) for a in made] == [4, 4, 2, 1, 1]
    assert [len(rows) for a in made for rows in a.to_pylist()] == [len(H.shred_one(h, "generic")) for h in pages.to_pylist()]
    nested = pa.array([[page], None, [page, page], [], ["", None]] * 3)
    made = list(H.shred_fragments.func(iter([nested])))
    assert len(made) > 2 and sum(map(len, made)) == 15
    assert [[len(f) for f in own] for a in made for own in a.to_pylist()] == [[len(H.shred_one(h, "generic")) for h in own or []] for own in nested.to_pylist()]
    texts = pa.array([json.dumps({"a": {"b": "x" * (PIECE_BYTES // 2 - 30)}}), None, "no"] * 4)
    assert sum(1 for _ in flatten_json.func(iter([texts]))) == 2
    assert [dict(m).keys() for a in flatten_json.func(iter([texts])) for m in a.to_pylist()] == [{"a": 0, "b": 0}.keys(), set(), set()] * 4
    assert [len(a) for a in R._rows(True, frozenset()).func(iter([texts]))] == [6, 6]


def brute_sections(html):
    """(heading, text, start) of every section below the article, straight from the node rows."""
    rows = H.shred_one(html)
    article = next(r for r in rows if r[3] == "article")
    kept = [r for r in rows[article[0] + 1 : article[1]] if r[5] is not None and not r[9] and r[5].strip()]
    heads = [r for r in rows[article[0] + 1 : article[1]] if r[3] and r[3][0] == "h" and r[3][1:].isdigit() and not r[9]]
    whole, out = "\n".join(r[5].strip() for r in kept), []
    for h in heads:
        later = [o[0] for o in heads if o[0] > h[0] and o[2] == h[2] and o[3] <= h[3]]
        end = min([*later, rows[h[2]][1] if h[2] >= 0 else article[1]][0], article[1])
        title = "".join(r[5].strip() for r in rows[h[0] + 1 : h[1]] if r[5] is not None and not r[9])
        text = "\n".join(r[5].strip() for r in kept if h[1] <= r[0] < end)
        out.append((title, text, max(whole.find(title), 0)))
    return out


def test_sections_of_headings_below_several_parents(spark):
    r, pages = random.Random(4), ["<article><h2></h2></article>", "<article><div><h1>a</div><p>b", f"<article>{'word ' * 30}</article>"]
    for _ in range(25):
        body, open_ = [], 0
        for i in range(r.randint(1, 60)):
            kind = r.random()
            if kind < 0.2:
                body.append("<div>")
                open_ += 1
            elif kind < 0.35 and open_:
                body.append("</div>")
                open_ -= 1
            elif kind < 0.7:
                level = r.randint(1, 6)
                body.append(f"<h{level}>H <b>{i}</b></h{level}>" if r.random() < 0.5 else f"<h{level}>H {i % 7}</h{level}>")
            else:
                body.append(f"<p>text {i} <i>more</i></p>" if r.random() < 0.8 else "loose ")
        pages.append(f"<html><body><p>before</p><article><p>{'opening ' * 9}</p>{''.join(body)}</article><h1>after</h1></body></html>")
    rows = spark.createDataFrame([(i, "http://e.example/p", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {x.page_id: x for x in K.extract_pages(rows, reduce=False).select("page_id", "sections", "selector_used").collect()}
    for i, page in enumerate(pages[2:], 2):
        assert got[i].selector_used == "fallback:semantic:article"
        found = [(s.heading_text, s.text, s.char_offset_start) for s in got[i].sections if s.heading_text is not None]
        assert found == brute_sections(page)
    assert len(got) == len(pages)


def test_sections_take_time_in_proportion_to_the_page(spark):
    """Thousands of headings: with the end of a section searched for each of its strings this took many minutes."""
    lines = 2000
    html = "".join(f"<h{1 + i % 2}>S {i}</h{1 + i % 2}><p>line {i}</p>" for i in range(lines))
    began = time.monotonic()
    found = extract(spark, f"<html><body><article>{html}</article></body></html>").sections
    assert time.monotonic() - began < 90
    assert [(s.heading_text, s.text) for s in found[:2]] == [("S 0", "line 0\nS 1\nline 1"), ("S 1", "line 1")] and len(found) == lines
