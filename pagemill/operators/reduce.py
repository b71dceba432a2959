"""Boilerplate and duplicate reduction of text blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.arrays import first_occurrences
from pagemill.functions.text import (
    DUPLICATE_MIN_CHARS,
    is_noise_line,
    markdown_block_text,
    normalize_block,
    strip,
)

SECTIONS = (
    "array<struct<heading_text:string,heading_level:int,section_path:array<string>,"
    "text:string,markdown:string,char_offset_start:int,char_offset_end:int>>"
)


def _duplicate_key(text: Column, position: Column) -> Column:
    """Lower-cased long text; short text gets a key of its own, so it is never a duplicate."""
    return F.when(F.length(text) >= DUPLICATE_MIN_CHARS, F.lower(text)).otherwise(
        F.concat(F.lit("\u0000"), position.cast("string"))
    )


def drop_repeats(values: Column) -> Column:
    """Drop later copies of values of at least 24 characters, ignoring case."""
    return first_occurrences(values, _duplicate_key)


def reduce_lines(values: Column) -> Column:
    """Lines without page furniture and without repeats."""
    return drop_repeats(F.filter(values, lambda x: ~is_noise_line(x)))


def reduce_markdown(markdown: Column) -> Column:
    """Markdown without noise and repeated blocks: ``struct<text, markdown>``."""
    blocks = F.filter(F.transform(F.split(markdown, "\n\n", -1), normalize_block), lambda b: b != "")
    tagged = F.transform(blocks, lambda b: F.struct(markdown_block_text(b).alias("text"), b.alias("markdown")))
    kept = first_occurrences(
        F.filter(tagged, lambda b: ~is_noise_line(b["text"])), lambda b, i: _duplicate_key(b["text"], i)
    )
    texts = F.filter(F.transform(kept, lambda b: b["text"]), lambda t: t != "")
    return F.struct(
        strip(F.array_join(texts, "\n")).alias("text"),
        strip(F.array_join(F.transform(kept, lambda b: b["markdown"]), "\n\n")).alias("markdown"),
    )


def section(
    text: Column, markdown: Column, heading: Column | None = None, level: Column | None = None,
    path: Column | None = None, start: Column | None = None, stop: Column | None = None,
) -> Column:
    """One section of a document."""
    begin = F.lit(0) if start is None else start
    return F.struct(
        (F.lit(None) if heading is None else heading).cast("string").alias("heading_text"),
        (F.lit(None) if level is None else level).cast("int").alias("heading_level"),
        (F.array() if path is None else path).cast("array<string>").alias("section_path"),
        text.alias("text"),
        markdown.alias("markdown"),
        begin.cast("int").alias("char_offset_start"),
        (begin + F.length(text) if stop is None else stop).cast("int").alias("char_offset_end"),
    )


def reduce_sections(sections: Column) -> Column:
    """Reduce every section, drop the emptied ones and lay the rest out two characters apart."""
    reduced = F.filter(
        F.transform(sections, lambda s: F.struct(s.alias("own"), reduce_markdown(s["markdown"]).alias("new"))),
        lambda r: r["new"]["text"] != "",
    )
    zero = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast(SECTIONS).alias("out"))

    def lay_out(acc: Column, r: Column) -> Column:
        text = r["new"]["text"]
        markdown = F.when(r["new"]["markdown"] == "", text).otherwise(r["new"]["markdown"])
        own = section(
            text, markdown, r["own"]["heading_text"], r["own"]["heading_level"], r["own"]["section_path"], acc["at"]
        )
        return F.struct(
            (acc["at"] + F.length(text) + 2).cast("int").alias("at"),
            F.concat(acc["out"], F.array(own)).alias("out"),
        )

    return F.aggregate(reduced, zero, lay_out, lambda acc: acc["out"])


def sections_text(sections: Column) -> Column:
    return strip(F.array_join(F.transform(sections, lambda s: s["text"]), "\n\n"))


def sections_markdown(sections: Column) -> Column:
    return strip(F.array_join(F.transform(sections, lambda s: s["markdown"]), "\n\n"))
