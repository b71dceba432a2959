"""Page content: main text, markdown, sections and chunks from node arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions.arrays import first_occurrences, let
from pagemill.functions.text import DUPLICATE_MIN_CHARS, collapse, doc_id, is_noise_line, strip
from pagemill.operators import chunk as C
from pagemill.operators.reduce import section

LEAF_BLOCKS = ("p", "li", "div", "span")
NOT_LEAF = ("h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol")
HEADINGS = "array<struct<level:int,text:string>>"


def _within(node: Column, span: Column) -> Column:
    return (node["pre"] > span["pre"]) & (node["pre"] < span["stop"])


def unwanted_blocks(nodes: Column, span: Column) -> Column:
    """Leaf blocks that are page furniture or repeat an earlier paragraph or list item."""
    blocks = F.filter(
        nodes,
        lambda n: n["tag"].isin(*LEAF_BLOCKS) & ~n["dropped"] & _within(n, span)
        & ~F.exists(H.subtree(nodes, n), lambda x: F.coalesce(x["tag"].isin(*NOT_LEAF), F.lit(False))),
    )
    read = F.transform(
        blocks,
        lambda n: F.struct(
            n["pre"].alias("pre"), n["stop"].alias("stop"), n["tag"].alias("tag"),
            collapse(H.text_of(nodes, n, " ", clean=True)).alias("text"),
        ),
    )

    def split(found: Column) -> Column:
        noise = F.filter(found, lambda b: is_noise_line(b["text"]))
        long = F.filter(
            found,
            lambda b: b["tag"].isin("p", "li") & (F.length(b["text"]) >= DUPLICATE_MIN_CHARS) & ~is_noise_line(b["text"]),
        )
        firsts = F.transform(first_occurrences(long, lambda b, _: F.lower(b["text"])), lambda b: b["pre"])
        repeats = let(firsts, lambda kept: F.filter(long, lambda b: ~F.array_contains(kept, b["pre"])))
        return F.concat(noise, repeats)

    return F.transform(let(read, split), lambda b: F.struct(b["pre"].alias("pre"), b["stop"].alias("stop")))


def kept_strings(nodes: Column, span: Column, unwanted: Column | None = None) -> Column:
    """Text nodes of the main content, stripped, without the unwanted blocks."""
    inside = F.slice(nodes, span["pre"] + 2, F.greatest(span["stop"] - span["pre"] - 1, F.lit(0)))
    kept = F.filter(inside, lambda n: n["text"].isNotNull() & ~n["dropped"] & (strip(n["text"]) != ""))
    if unwanted is not None:
        # Bound once: the optimizer inlines a column into a lambda that reads it a single time.
        everything = kept
        kept = let(
            unwanted,
            lambda drop: F.filter(
                everything, lambda n: ~F.exists(drop, lambda u: (u["pre"] < n["pre"]) & (n["pre"] < u["stop"]))
            ),
        )
    return F.transform(
        kept,
        lambda n: F.struct(
            n["pre"].alias("pre"), n["block"].alias("block"), n["block_tag"].alias("block_tag"),
            n["marks"].alias("marks"), H.attribute(n, "href").alias("href"), strip(n["text"]).alias("text"),
        ),
    )


def as_text(kept: Column) -> Column:
    return F.array_join(F.transform(kept, lambda n: n["text"]), "\n")


def as_markdown(kept: Column) -> Column:
    """ATX headings, ``-`` bullets, emphasis, code and links."""

    def inline(n: Column) -> Column:
        out = n["text"]
        for mark, sign in (("c", "`"), ("i", "*"), ("b", "**")):
            out = F.when(n["marks"].contains(mark), F.concat(F.lit(sign), out, F.lit(sign))).otherwise(out)
        return F.when(
            n["href"].isNotNull(), F.concat(F.lit("["), out, F.lit("]("), n["href"], F.lit(")"))
        ).otherwise(out)

    def lead(n: Column) -> Column:
        level = F.substring(n["block_tag"], 2, 1).cast("int")
        return (
            F.when(n["block_tag"].rlike("^h[1-6]$"), F.concat(F.repeat(F.lit("#"), level), F.lit(" ")))
            .when(n["block_tag"] == "li", F.lit("- "))
            .when(n["block_tag"] == "blockquote", F.lit("> "))
            .otherwise(F.lit(""))
        )

    def render(all_kept: Column) -> Column:
        before = F.transform(F.slice(all_kept, 1, F.greatest(F.size(all_kept) - 1, F.lit(0))), lambda n: n["block"])
        pairs = F.arrays_zip(
            all_kept.alias("n"), F.slice(F.concat(F.array(F.lit(None).cast("int")), before), 1, F.size(all_kept)).alias("b")
        )
        return F.array_join(
            F.transform(
                pairs,
                lambda p: F.when(p["b"].isNull(), F.concat(lead(p["n"]), inline(p["n"])))
                .when(p["b"] == p["n"]["block"], F.concat(F.lit(" "), inline(p["n"])))
                .otherwise(F.concat(F.lit("\n\n"), lead(p["n"]), inline(p["n"]))),
            ),
            "",
        )

    return let(kept, render)


def headings(nodes: Column, span: Column) -> Column:
    """Headings of the main content with their section path.

    The path is a stack: a heading closes every open one of its own or a deeper level.
    """
    found = F.filter(nodes, lambda n: n["tag"].rlike("^h[1-6]$") & ~n["dropped"] & _within(n, span))
    read = F.transform(
        found,
        lambda n: F.struct(
            n["pre"].alias("pre"), n["stop"].alias("stop"), n["parent"].alias("parent"),
            F.substring(n["tag"], 2, 1).cast("int").alias("level"),
            F.array_join(H.strings(nodes, n, clean=True), "").alias("text"),
        ),
    )
    row = "struct<pre:int,stop:int,parent:int,level:int,text:string,path:array<string>>"
    zero = F.struct(F.array().cast(HEADINGS).alias("open"), F.array().cast(f"array<{row}>").alias("out"))

    def step(acc: Column, h: Column) -> Column:
        own = F.struct(h["level"].alias("level"), h["text"].alias("text"))
        stack = F.concat(F.filter(acc["open"], lambda o: o["level"] < h["level"]), F.array(own))
        entry = F.struct(
            h["pre"].alias("pre"), h["stop"].alias("stop"), h["parent"].alias("parent"), h["level"].alias("level"),
            h["text"].alias("text"), F.transform(stack, lambda o: o["text"]).alias("path"),
        )
        return F.struct(stack.alias("open"), F.concat(acc["out"], F.array(entry)).alias("out"))

    return F.aggregate(read, zero, step, lambda acc: acc["out"])


def _following(heads: Column) -> Column:
    """For every heading, in order, where the next one below the same parent and of the same or a higher level starts;
    null without one. In order of parent and start it is the next neighbour among those of its level and above."""
    placed = F.transform(
        heads,
        lambda h, i: F.struct(h["parent"].alias("parent"), h["pre"].alias("pre"), h["level"].alias("level"), i.alias("i")),
    )

    def of_level(some: Column, level: int) -> Column:
        pairs = F.arrays_zip(some.alias("own"), F.slice(some, 2, F.size(some)).alias("next"))
        return F.transform(
            F.filter(pairs, lambda p: p["own"]["level"] == level),
            lambda p: F.struct(
                p["own"]["i"].alias("i"), F.when(p["own"]["parent"] == p["next"]["parent"], p["next"]["pre"]).alias("pre")
            ),
        )

    def all_levels(ordered: Column) -> Column:
        found = [
            let(F.filter(ordered, lambda h: h["level"] <= level), lambda some: of_level(some, level))  # noqa: B023
            for level in range(1, 7)
        ]
        return F.transform(F.sort_array(F.concat(*found)), lambda f: f["pre"])

    return let(F.sort_array(placed), all_levels)


def _kept_before(nodes: Column, kept: Column) -> Column:
    """For every place of a page, its end included, how many kept strings stand before it."""

    def counted(starts: Column) -> Column:
        gaps = F.transform(
            starts, lambda pre, i: F.array_repeat(i, pre - F.when(i > 0, F.get(starts, i - 1)).otherwise(F.lit(-1)))
        )
        rest = F.size(nodes) - F.coalesce(F.get(starts, F.size(starts) - 1), F.lit(-1))
        return F.flatten(F.concat(gaps, F.array(F.array_repeat(F.size(starts), rest))))

    return let(F.transform(kept, lambda n: n["pre"]), counted)


def _bodies(nodes: Column, span: Column, kept: Column, heads: Column) -> Column:
    """Which kept strings belong to each heading: ``array<struct<first, n>>``, in time in proportion to the page."""

    def body(head: Column, following: Column, before: Column) -> Column:
        parent_end = F.when(
            head["parent"] >= 0, F.element_at(nodes, F.greatest(head["parent"] + 1, F.lit(1)))["stop"]
        ).otherwise(span["stop"])
        end = F.least(F.coalesce(following, parent_end), span["stop"])
        first = F.get(before, head["stop"])
        return F.struct(first.alias("first"), F.greatest(F.get(before, end) - first, F.lit(0)).alias("n"))

    return let(
        _following(heads),
        lambda following: let(
            _kept_before(nodes, kept),
            lambda before: F.zip_with(heads, following, lambda h, f: body(h, f, before)),
        ),
    )


def sections(nodes: Column, span: Column, kept: Column, full_text: Column, heads: Column) -> Column:
    """Sections by heading: what follows among its siblings up to one of the same or a higher level."""

    def from_heading(head: Column, body: Column) -> Column:
        def build(own: Column) -> Column:
            text = as_text(own)
            start = F.greatest(F.instr(full_text, head["text"]) - 1, F.lit(0))
            title = F.concat(F.repeat(F.lit("#"), head["level"]), F.lit(" "), head["text"])
            markdown = F.array_join(F.filter(F.array(title, as_markdown(own)), lambda x: x != ""), "\n\n")
            stop = F.least(start + F.length(head["text"]) + F.length(text), F.length(full_text))
            return section(text, markdown, head["text"], head["level"], head["path"], start, stop)

        return let(F.slice(kept, body["first"] + 1, body["n"]), build)

    first_head = F.element_at(heads, 1)["pre"]
    preamble = F.when(F.size(heads) > 0, F.filter(kept, lambda n: n["pre"] < first_head)).otherwise(kept)
    opening = F.filter(
        F.array(let(preamble, lambda own: section(as_text(own), as_markdown(own)))),
        lambda s: (s["text"] != "") | (F.size(heads) == 0),
    )
    return F.concat(opening, F.zip_with(heads, _bodies(nodes, span, kept, heads), from_heading))


def extract_pages(pages: DataFrame, html: str = "html", url: str = "url", reduce: bool = True) -> DataFrame:
    """Add ``selector_used, plain_text, markdown, sections, noise_removed, content_ratio, doc_id``.

    Uses ``platform`` and ``resource_type`` columns when the table has them. The node array stays
    in the ``nodes`` column so metadata can be read from the same parse.
    """
    has_platform = "platform" in pages.columns
    platform = F.col("platform") if has_platform else None
    kind = F.col("resource_type") if has_platform else None
    named = F.coalesce(platform, F.lit("generic")) if has_platform else F.lit("generic")
    nodes, span, kept, heads = F.col("nodes"), F.col("_span"), F.col("_kept"), F.col("_heads")
    parsed = pages.withColumn("nodes", H.shred(F.col(html), named))
    parsed = parsed.withColumn("_span", H.main_span(nodes, platform, kind))
    unwanted = unwanted_blocks(nodes, span) if reduce else None
    if reduce:
        parsed = parsed.withColumn("_unwanted", unwanted)
        unwanted = F.col("_unwanted")
    parsed = parsed.withColumn("_kept", kept_strings(nodes, span, unwanted))
    parsed = parsed.withColumns({"plain_text": as_text(kept), "_heads": headings(nodes, span)})
    return parsed.withColumns(
        {
            "markdown": as_markdown(kept),
            "sections": sections(nodes, span, kept, F.col("plain_text"), heads),
            "selector_used": F.concat(F.lit("fallback:"), span["selector"]),
            "noise_removed": H.noise_removed(nodes),
            "content_ratio": F.length("plain_text") / F.greatest(F.length(html), F.lit(1)),
            "doc_id": doc_id(F.col(url), named),
        }
    ).drop("_span", "_kept", "_heads", "_unwanted")


def page_chunks(
    pages: DataFrame, max_tokens: int = C.MAX_TOKENS, min_tokens: int = C.MIN_TOKENS, overlap: int = C.OVERLAP_TOKENS
) -> DataFrame:
    """One row per chunk of every extracted page."""
    pieces = C.section_pieces(F.col("sections"), max_tokens, min_tokens, overlap)
    return C.explode_chunks(pages.withColumn("_pieces", pieces).drop("sections", "nodes"), "_pieces", "doc_id")
