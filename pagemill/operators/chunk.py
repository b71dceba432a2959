"""Token-bounded chunking, whole texts, per row and inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.arrays import joined, let, pack_ranges
from pagemill.functions.text import SPACE, filled_lines, strip, token_estimate, word_tokens

# Estimated tokens per chunk.
MAX_TOKENS = 512
MIN_TOKENS = 100
OVERLAP_TOKENS = 50

PIECES = (
    "array<struct<text:string,markdown:string,section_path:array<string>,heading_text:string,"
    "heading_level:int,char_offset_start:int,char_offset_end:int,source_element:string,"
    "token_count_estimate:int>>"
)


def word_segments(text: Column, max_tokens: int = MAX_TOKENS) -> Column:
    """Text cut between words into segments of at most ``max_tokens``."""
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    return let(words, lambda w: _groups(w, max_tokens, 0, " ", word_tokens))


def _groups(parts: Column, max_tokens: int, overlap: int, separator: str, weight=token_estimate) -> Column:
    spans = pack_ranges(F.transform(parts, weight), max_tokens, overlap)
    return F.transform(spans, lambda r: joined(parts, r, separator))


def paragraph_groups(text: Column, max_tokens: int = MAX_TOKENS, overlap: int = 0) -> Column:
    """Paragraphs of a text packed greedily, joined with line breaks."""
    return let(filled_lines(text), lambda parts: _groups(parts, max_tokens, overlap, "\n"))


def _piece(text, markdown, owner, start, stop, source, tokens) -> Column:
    return F.struct(
        text.alias("text"),
        markdown.alias("markdown"),
        owner["section_path"].alias("section_path"),
        owner["heading_text"].alias("heading_text"),
        owner["heading_level"].alias("heading_level"),
        start.cast("int").alias("char_offset_start"),
        stop.cast("int").alias("char_offset_end"),
        F.lit(source).alias("source_element"),
        tokens.cast("int").alias("token_count_estimate"),
    )


def _split_section(own: Column, max_tokens: int, overlap: int) -> Column:
    return let(filled_lines(own["text"]), lambda lines: _split_lines(own, lines, max_tokens, overlap))


def _split_lines(own: Column, lines: Column, max_tokens: int, overlap: int) -> Column:
    lone = (F.size(lines) == 1) & (token_estimate(own["text"]) > max_tokens)
    parts = F.when(lone, word_segments(strip(own["text"]), max_tokens)).otherwise(lines)
    blocks = F.filter(F.transform(F.split(own["markdown"], "\n\n", -1), strip), lambda b: b != "")
    marks = F.when(F.size(blocks) == F.size(parts), blocks).otherwise(parts)
    marks = F.when(lone, parts).otherwise(marks)
    return let(parts, lambda p: let(marks, lambda m: _place_parts(own, p, m, max_tokens, overlap)))


def _place_parts(own: Column, parts: Column, marks: Column, max_tokens: int, overlap: int) -> Column:
    spans = pack_ranges(F.transform(parts, token_estimate), max_tokens, overlap)
    # How many parts a range shares with the one after it.
    shared = let(
        spans,
        lambda ranges: F.transform(
            F.arrays_zip(ranges.alias("own"), F.slice(ranges, 2, F.size(ranges)).alias("next")),
            lambda p: F.struct(
                p["own"]["first"].alias("first"),
                p["own"]["stop"].alias("stop"),
                F.coalesce(F.greatest(p["own"]["stop"] - p["next"]["first"], F.lit(0)), F.lit(0)).alias("kept"),
            ),
        ),
    )
    zero = F.struct(own["char_offset_start"].cast("int").alias("at"), F.array().cast(PIECES).alias("out"))

    def place(acc: Column, span: Column) -> Column:
        text = joined(parts, span, "\n")
        carried = F.aggregate(
            F.slice(parts, span["stop"] - span["kept"] + 1, span["kept"]),
            F.lit(0),
            lambda n, p: n + F.length(p),
        )
        piece = _piece(
            text, joined(marks, span, "\n\n"), own, acc["at"], acc["at"] + F.length(text),
            "paragraph_group", token_estimate(text),
        )
        return F.struct(
            (acc["at"] + F.length(text) - carried).cast("int").alias("at"),
            F.concat(acc["out"], F.array(piece)).alias("out"),
        )

    return F.aggregate(shared, zero, place, lambda acc: acc["out"])


def _merge_small(pieces: Column, min_tokens: int, max_tokens: int) -> Column:
    """Append a small piece to the one before it when both share a section path."""

    def fold(acc: Column, piece: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        total = last["token_count_estimate"] + piece["token_count_estimate"]
        fits = (
            (F.size(acc) > 0)
            & (piece["token_count_estimate"] < min_tokens)
            & (total <= max_tokens)
            & (last["section_path"] == piece["section_path"])
        )
        merged = F.struct(
            F.concat(last["text"], F.lit("\n"), piece["text"]).alias("text"),
            F.concat(last["markdown"], F.lit("\n\n"), piece["markdown"]).alias("markdown"),
            last["section_path"].alias("section_path"),
            last["heading_text"].alias("heading_text"),
            last["heading_level"].alias("heading_level"),
            last["char_offset_start"].alias("char_offset_start"),
            piece["char_offset_end"].alias("char_offset_end"),
            last["source_element"].alias("source_element"),
            total.cast("int").alias("token_count_estimate"),
        )
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(merged))
        return F.when(F.coalesce(fits, F.lit(False)), grown).otherwise(F.concat(acc, F.array(piece)))

    return F.aggregate(pieces, F.array().cast(PIECES), fold)


def section_pieces(
    sections: Column, max_tokens: int = MAX_TOKENS, min_tokens: int = MIN_TOKENS, overlap: int = OVERLAP_TOKENS
) -> Column:
    """Sections as chunk pieces: small sections whole, large ones split with overlap, tiny ones merged."""

    def cut(own: Column) -> Column:
        return let(token_estimate(own["text"]), lambda tokens: sized(own, tokens))

    def sized(own: Column, tokens: Column) -> Column:
        whole = F.array(
            _piece(
                own["text"], own["markdown"], own, own["char_offset_start"], own["char_offset_end"], "section", tokens
            )
        )
        return F.when(tokens <= max_tokens, whole).otherwise(_split_section(own, max_tokens, overlap))

    filled = F.filter(sections, lambda s: strip(s["text"]) != "")
    return _merge_small(F.flatten(F.transform(filled, cut)), min_tokens, max_tokens)


def plain_pieces(text: Column, max_tokens: int = MAX_TOKENS) -> Column:
    """Chunk pieces of a text without sections; offsets do not count separators."""
    owner = F.struct(
        F.array().cast("array<string>").alias("section_path"),
        F.lit(None).cast("string").alias("heading_text"),
        F.lit(None).cast("int").alias("heading_level"),
    )
    zero = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast(PIECES).alias("out"))

    def place(acc: Column, part: Column) -> Column:
        stop = acc["at"] + F.length(part)
        piece = _piece(part, part, owner, acc["at"], stop, "paragraph_group", token_estimate(part))
        return F.struct(stop.cast("int").alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    return F.aggregate(paragraph_groups(text, max_tokens), zero, place, lambda acc: acc["out"])


def explode_chunks(df: DataFrame, pieces: str, doc_id: str) -> DataFrame:
    """One row per chunk, numbered within its document."""
    kept = [c for c in df.columns if c not in (pieces, doc_id)]
    rows = explode_once(df.select(doc_id, *kept, pieces), pieces, "chunk_index", "_piece")
    chunk_id = F.concat(F.col(doc_id).cast("string"), F.lit("#chunk_"), F.col("chunk_index").cast("string"))
    return rows.select(doc_id, *kept, chunk_id.alias("chunk_id"), "chunk_index", "_piece.*")


def explode_once(df: DataFrame, column: str, position: str, value: str) -> DataFrame:
    """``posexplode`` that computes an expensive array once.

    The inner form makes the optimizer test ``size(array) > 0`` below the generator, which
    computes the array again; the outer form with a later filter does not.
    """
    others = [c for c in df.columns if c != column]
    rows = df.select(*others, F.posexplode_outer(column).alias(position, value))
    return rows.filter(F.col(position).isNotNull())
