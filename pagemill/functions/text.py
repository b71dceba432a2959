"""Text functions: whitespace, token estimate, markdown, notes found in prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.arrays import let

# The characters that count as white space, and the ideograph ranges
# that count as one token per character.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
NOT_IDEOGRAPH = r"[^\u4e00-\u9fff\u3000-\u303f]+"

# Lines that are page furniture, matched on lower-cased, collapsed text.
NOISE_LINES = (
    r"^sign in(?:\b| to\b)",
    r"^sign up(?:\b| for\b)",
    r"^share (?:this|the) (?:article|post|page)$",
    r"^all rights reserved\.?$",
    r"^cookie (?:preferences|policy|settings)$",
    r"^accept cookies$",
    r"^subscribe(?: now)?$",
    r"^skip to content$",
)
#: Shortest text that takes part in duplicate removal.
DUPLICATE_MIN_CHARS = 24

# Heading keyword -> section type, first match wins.
SECTION_TYPES = (
    ("introduction", "introduction"),
    ("related work", "related_work"),
    ("method", "methodology"),
    ("experiment", "experiment"),
    ("result", "results"),
    ("discussion", "discussion"),
    ("conclusion", "conclusion"),
    ("reference", "references"),
)

# Subject codes with a plain-English name.
CATEGORY_NAMES = {
    "cs.CL": "Natural language processing",
    "cs.AI": "Artificial intelligence",
    "cs.LG": "Machine learning",
    "stat.ML": "Statistical machine learning",
}


def strip(value: Column) -> Column:
    """Remove white space from both ends."""
    return F.btrim(value, F.lit(WHITESPACE))


def rstrip(value: Column) -> Column:
    return F.rtrim(value, F.lit(WHITESPACE))


def collapse(value: Column) -> Column:
    """Every run of white space becomes one space; ends are stripped."""
    return strip(F.regexp_replace(value, SPACE, " "))


def lines(value: Column) -> Column:
    return F.split(value, "\n", -1)


def filled_lines(value: Column) -> Column:
    """Stripped, non-empty lines."""
    return F.filter(F.transform(lines(value), strip), lambda x: x != "")


def _ideographs(value: Column) -> Column:
    # Text of one byte a character has none.
    return F.when(F.octet_length(value) == F.length(value), F.lit(0)).otherwise(F.length(F.regexp_replace(value, NOT_IDEOGRAPH, "")))


def word_tokens(word: Column) -> Column:
    """The token estimate of a word: non-empty text without white space."""
    return (F.lit(1) + _ideographs(word)).cast("int")


def token_estimate(value: Column) -> Column:
    """Words plus ideographs; any non-empty text counts at least one."""
    # Splitting is several times faster in the JVM than counting matches of a negated class.
    bare = strip(value)
    words = F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE, -1)))
    ideographs = _ideographs(value)
    return (
        F.when(value.isNull() | (value == ""), F.lit(0))
        .otherwise(F.greatest(F.lit(1), words + ideographs))
        .cast("int")
    )


def is_noise_line(value: Column) -> Column:
    """True for empty text and for page furniture such as a cookie banner."""
    flat = F.lower(collapse(value))
    return (flat == "") | flat.rlike("|".join(f"(?:{p})" for p in NOISE_LINES))


def normalize_block(block: Column) -> Column:
    """Collapse each line of a markdown block and drop the empty ones."""
    return F.array_join(F.filter(F.transform(lines(block), collapse), lambda x: x != ""), "\n")


def markdown_block_text(block: Column) -> Column:
    """Markdown block without its line prefixes and emphasis marks."""

    def bare(line: Column) -> Column:
        out = strip(line)
        for prefix in (r"^#{1,6}\s+", r"^[-*+]\s+", r"^\d+\.\s+"):
            out = F.regexp_replace(out, prefix, "")
        return F.replace(F.replace(F.replace(out, F.lit("**")), F.lit("__")), F.lit("`"))

    return strip(F.array_join(F.filter(F.transform(lines(block), bare), lambda x: x != ""), "\n"))


def markdown_plain_text(markdown: Column) -> Column:
    """Whole markdown document as plain text."""
    out = F.regexp_replace(markdown, r"(?s)```.*?```", "")
    out = F.regexp_replace(out, r"!\[[^\]]*\]\([^)]+\)", "")
    out = F.regexp_replace(out, r"\[([^\]]+)\]\([^)]+\)", "$1")
    out = F.regexp_replace(out, r"(?md)^[#>\-*\d.\s]+", "")
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def drop_page_furniture(markdown: Column, title: Column | None = None) -> Column:
    """Drop ``Page N`` lines and every repeat of the title line; squeeze blank runs."""
    text = F.regexp_replace(markdown, r"\r\n?", "\n")
    kept = F.filter(
        F.transform(lines(text), rstrip), lambda x: ~strip(x).rlike(r"^Page\s+\d+$")
    )
    if title is not None:
        shown = F.coalesce(title, F.lit(""))
        first = F.when(shown == "", F.lit(0)).otherwise(F.array_position(F.transform(kept, strip), shown))
        kept = let(
            F.struct(kept.alias("lines"), first.alias("first"), shown.alias("title")),
            lambda k: F.filter(
                k["lines"],
                lambda x, i: (k["first"] == 0) | (i + 1 <= k["first"]) | (strip(x) != k["title"]),
            ),
        )
    return strip(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))


def markdown_sections(markdown: Column, summary_chars: int | None = None) -> Column:
    """ATX headings as ``array<struct<heading, content_summary, section_type>>``.

    ``content_summary`` is the first line under the heading, cut to ``summary_chars`` only where that is given.
    """
    cut = (lambda c: c) if summary_chars is None else (lambda c: F.substring(c, 1, summary_chars))
    marked = F.regexp_replace(markdown, r"(?md)^(#{1,6})\s+(.+)$", "\u0001$2\u0002")
    pieces = F.split(marked, "\u0001", -1)
    parts = F.slice(pieces, 2, F.size(pieces))

    def section(part: Column) -> Column:
        heading = strip(F.substring_index(part, "\u0002", 1))
        body = strip(F.substr(part, F.locate("\u0002", part) + 1))
        kind = F.lit("body")
        for key, name in reversed(SECTION_TYPES):
            kind = F.when(F.lower(heading).contains(key), F.lit(name)).otherwise(kind)
        return F.struct(
            heading.alias("heading"),
            cut(F.substring_index(body, "\n", 1)).alias("content_summary"),
            kind.alias("section_type"),
        )

    whole = strip(markdown)
    lone = F.array(
        F.struct(
            F.lit("Main").alias("heading"),
            cut(F.substring_index(whole, "\n", 1)).alias("content_summary"),
            F.lit("body").alias("section_type"),
        )
    )
    found = F.transform(parts, section)
    return F.when(F.size(parts) > 0, found).when(whole != "", lone).otherwise(found)


def reference_lines(markdown: Column) -> Column:
    """Bracketed or numbered lines below the ``# References`` heading."""
    block = F.regexp_extract(markdown, r"(?imsd)^##?\s*references\s*$(.+)\z", 1)
    return F.filter(filled_lines(block), lambda x: x.startswith("[") | x.rlike(r"^\d+\."))


def urls_in(value: Column) -> Column:
    """Sorted distinct http(s) addresses found in prose."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(value, F.lit(r"(https?://[^\s)>\]]+)"))))


def paper_ids_in(value: Column) -> Column:
    """Sorted distinct preprint numbers found in prose."""
    pattern = F.lit(r"(?U)(\b\d{4}\.\d{4,5}(?:v\d+)?\b)")
    return F.array_sort(F.array_distinct(F.regexp_extract_all(value, pattern)))


def strip_latex(value: Column) -> Column:
    """Unwrap ``\\cmd{x}``, drop math delimiters and collapse; NULL when nothing is left."""
    out = F.regexp_replace(value, r"\\[a-zA-Z]+\{([^{}]+)\}", "$1")
    return F.nullif(collapse(F.regexp_replace(out, r"[${}]", "")), F.lit(""))


def author_name(value: Column) -> Column:
    """Full name split into first and last word."""
    words = F.filter(F.split(strip(value), SPACE), lambda x: x != "")
    return F.struct(
        value.alias("full_name"),
        F.coalesce(F.try_element_at(words, F.lit(1)), F.lit("")).alias("first_name"),
        F.when(F.size(words) > 1, F.element_at(words, -1)).otherwise(F.lit("")).alias("last_name"),
    )


def category_name(code: Column) -> Column:
    """Plain-English subject name; unknown codes stay as they are."""
    names = F.create_map(*[F.lit(x) for pair in CATEGORY_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), F.nullif(code, F.lit("")))


def category_path(categories: Column, primary: Column) -> Column:
    """Archive, subject code and subject name of the leading category."""
    seed = F.coalesce(F.nullif(primary, F.lit("")), F.try_element_at(categories, F.lit(1)), F.lit(""))
    path = F.array(F.substring_index(seed, ".", 1), seed, category_name(seed))
    return F.filter(path, lambda x: x.isNotNull() & (x != ""))


def doc_id(url: Column, platform: Column) -> Column:
    """First 16 hex digits of SHA-256 over ``platform:url``."""
    return F.substring(F.sha2(F.concat_ws(":", platform, url), 256), 1, 16)


def slug(url: Column, ordinal: Column) -> Column:
    """Last path segment made safe for a folder name."""
    tail = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/", -1), -1)
    safe = F.regexp_replace(tail, r"[^\p{L}\p{N}\-_.]", "_")
    return F.when(safe == "", F.concat(F.lit("record-"), ordinal.cast("string"))).otherwise(safe)


def unfence(value: Column) -> Column:
    """JSON text without a surrounding code fence."""
    return strip(F.regexp_replace(strip(value), r"^```[a-zA-Z]*\s*|\s*```$", ""))
