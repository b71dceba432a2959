"""HTML as a node array.

``shred`` is the only Python step: it turns markup into a flat array of nodes in document order,
each with the interval ``[pre, stop)`` of its subtree. Everything after it - selectors, main
content, duplicate removal, sections, metadata - is expressed on that array inside the JVM.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import specs
from pagemill.functions.arrays import let
from pagemill.functions.batches import bounds, list_pieces, text_pieces
from pagemill.functions.text import strip

NODE = T.StructType(
    [
        T.StructField("pre", T.IntegerType()),
        T.StructField("stop", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("block_tag", T.StringType()),
        T.StructField("marks", T.StringType()),
        T.StructField("dropped", T.BooleanType()),
        T.StructField("size", T.IntegerType()),
        # Running sums over kept nodes, this one included: a subtree's text and markup are differences of two.
        T.StructField("text_sum", T.IntegerType()),
        T.StructField("size_sum", T.IntegerType()),
    ]
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header html li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - {"html", "body", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "li"} | {"hr"}
SIBLING_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table article section div main body html td th".split())
MARKS = {"b": "b", "strong": "b", "i": "i", "em": "i", "code": "c"}
KEPT_WHOLE = frozenset(("html", "body", "main", "article"))
CLASS_NOISE = re.compile(specs.NOISE_CLASS, re.I)
ID_NOISE = re.compile(specs.NOISE_ID, re.I)
HIDDEN = re.compile(r"display\s*:\s*none")


class _Shredder(HTMLParser):
    """Markup -> node rows. Open elements are kept on a stack of row numbers."""

    def __init__(self, noise_selectors: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []
        self.noise_ids = {s[1:] for s in noise_selectors if s.startswith("#")}
        self.noise_classes = {s[1:] for s in noise_selectors if s.startswith(".")}

    def _is_noise(self, tag: str, attrs: dict) -> bool:
        if tag in specs.NOISE_TAGS:
            return True
        if "hidden" in attrs or HIDDEN.search(attrs.get("style", "")):
            return True
        classes, own_id = attrs.get("class", ""), attrs.get("id", "")
        if own_id in self.noise_ids or self.noise_classes.intersection(classes.split()):
            return True
        if tag in KEPT_WHOLE:
            return False
        return bool(CLASS_NOISE.search(" ".join(classes.split())) or ID_NOISE.search(own_id))

    def _close_to(self, depth: int) -> None:
        for row in self.open[depth:]:
            self.rows[row][1] = len(self.rows)
        del self.open[depth:]

    def _close_implied(self, tag: str) -> None:
        names = [self.rows[r][3] for r in self.open]
        ends = SIBLING_ENDS.get(tag, ())
        for depth in range(len(names) - 1, -1, -1):
            if names[depth] in ends or (names[depth] == "p" and tag in ENDS_PARAGRAPH):
                self._close_to(depth)
                if names[depth] == "p" or tag != "tr":
                    return
            elif names[depth] in SCOPES:
                return

    def _add(self, tag, attrs, text, size) -> int:
        pre = len(self.rows)
        parent = self.open[-1] if self.open else -1
        dropped = parent >= 0 and self.rows[parent][9]
        block, block_tag, marks = -1, None, ""
        if tag is None:
            for row in reversed(self.open):
                name = self.rows[row][3]
                if name in BLOCK:
                    block, block_tag = row, name
                    break
                marks += MARKS.get(name, "")
                if name == "a" and self.rows[row][4].get("href"):
                    attrs = {"href": self.rows[row][4]["href"]}
        else:
            dropped = dropped or self._is_noise(tag, attrs)
        self.rows.append([pre, pre + 1, parent, tag, attrs, text, block, block_tag, marks, dropped, size])
        return pre

    def handle_starttag(self, tag, attrs):
        self._close_implied(tag)
        void = tag in VOID
        size = len(self.get_starttag_text() or "") + (0 if void else len(tag) + 3)
        row = self._add(tag, {k: v or "" for k, v in attrs}, None, size)
        if not void:
            self.open.append(row)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[depth]][3] == tag:
                self._close_to(depth)
                return

    def handle_data(self, data):
        self._add(None, {}, data, len(data))

    def unknown_decl(self, data):
        return


def shred_one(html: str | None, platform: str | None = "") -> list[tuple]:
    """Node rows of one page."""
    parser = _Shredder(specs.NOISE_SELECTORS.get(platform or "", ()))
    parser.feed(html or "")
    parser.close()
    parser._close_to(0)
    out, texts, sizes = [], 0, 0
    for row in parser.rows:
        if not row[9]:
            texts += len(row[5].strip()) if row[5] is not None else 0
            sizes += row[10]
        out.append((*row, texts, sizes))
    return out


_INT, _STRING, _ATTRS = pa.int32(), pa.string(), pa.map_(pa.string(), pa.string())
_COLUMNS = (_INT, _INT, _INT, _STRING, _ATTRS, _STRING, _INT, _STRING, _STRING, pa.bool_(), _INT, _INT, _INT)


def _node_lists(pages: list[list[tuple]]) -> pa.ListArray:
    """Node rows of pages as one Arrow array, column by column."""
    columns = []
    for kind, values in zip(_COLUMNS, list(zip(*(row for page in pages for row in page))) or [()] * len(_COLUMNS)):
        if kind == _ATTRS:
            keys, held = [k for v in values for k in v], [x for v in values for x in v.values()]
            columns.append(pa.MapArray.from_arrays(bounds([len(v) for v in values]), pa.array(keys, _STRING), pa.array(held, _STRING)))
        else:
            columns.append(pa.array(values, kind))
    nodes = pa.StructArray.from_arrays(columns, fields=[pa.field(n, c.type) for n, c in zip(NODE.names, columns)])
    return pa.ListArray.from_arrays(bounds([len(page) for page in pages]), nodes)


@F.arrow_udf(T.ArrayType(NODE))
def shred(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Markup and platform -> node array, a few pages at a time."""
    for html, platform in batches:
        for first, n in text_pieces(html):
            yield _node_lists([shred_one(h, p) for h, p in zip(html.slice(first, n).to_pylist(), platform.slice(first, n).to_pylist())])


@F.arrow_udf(T.ArrayType(T.ArrayType(NODE)))
def shred_fragments(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Pieces of markup of a row -> a node array each, so that markup nested in a page's data stays in the page's row."""
    for fragments in batches:
        for first, n in list_pieces(fragments):
            own = [f or [] for f in fragments.slice(first, n).to_pylist()]
            yield pa.ListArray.from_arrays(bounds([len(f) for f in own]), _node_lists([shred_one(h, "generic") for f in own for h in f]))


# --- selectors ------------------------------------------------------------------------------

Test = Callable[[Column], Column]
COMPOUND = re.compile(r"([a-zA-Z][\w-]*|\*)|#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:([*^$~]?=)[\"']?([^\"'\]]*)[\"']?)?\]")


def attribute(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def _compound(selector: str) -> Test:
    """Tag, ``#id``, ``.class`` and ``[attribute]`` tests on one node."""
    parts = COMPOUND.findall(selector)
    if not parts:
        raise ValueError(f"unsupported selector: {selector!r}")

    def test(node: Column) -> Column:
        out = node["tag"].isNotNull()
        for tag, own_id, cls, name, operator, value in parts:
            if tag and tag != "*":
                out = out & (node["tag"] == tag.lower())
            elif own_id:
                out = out & (attribute(node, "id") == own_id)
            elif cls:
                out = out & F.array_contains(F.split(attribute(node, "class"), r"\s+"), cls)
            elif name:
                held = attribute(node, name)
                checks = {
                    "": held.isNotNull(), "=": held == value, "*=": held.contains(value),
                    "^=": held.startswith(value), "$=": held.endswith(value),
                    "~=": F.array_contains(F.split(held, r"\s+"), value),
                }
                out = out & checks[operator]
        return F.coalesce(out, F.lit(False))

    return test


def _descendants(nodes: Column, selector: str) -> Test:
    *ancestors, own = [_compound(s) for s in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", selector)]

    def test(node: Column) -> Column:
        out = own(node)
        inner = node
        for ancestor in reversed(ancestors):
            around = F.filter(nodes, lambda a: ancestor(a) & (a["pre"] < inner["pre"]) & (inner["pre"] < a["stop"]))
            out = out & (F.size(around) > 0)
            inner = F.element_at(around, -1) if len(ancestors) > 1 else inner
        return out

    return test


def matching(nodes: Column, selector: str, within: Column | None = None) -> Column:
    """Element nodes matched by a selector list, in document order."""
    tests = [_descendants(nodes, s.strip()) for s in re.split(r",(?![^\[]*\])", selector)]

    def any_of(node: Column) -> Column:
        hit = F.lit(False)
        for test in tests:
            hit = hit | test(node)
        return hit

    scope = nodes if within is None else subtree(nodes, within)
    return F.filter(scope, any_of)


def first_match(nodes: Column, selector: str, within: Column | None = None) -> Column:
    return F.try_element_at(matching(nodes, selector, within), F.lit(1))


# --- text of a subtree ----------------------------------------------------------------------


def subtree(nodes: Column, node: Column) -> Column:
    """Nodes below an element: one slice, no search."""
    return F.slice(nodes, node["pre"] + 2, F.greatest(node["stop"] - node["pre"] - 1, F.lit(0)))


def strings(nodes: Column, node: Column, clean: bool = False) -> Column:
    """Stripped, non-empty strings below an element."""
    inside = subtree(nodes, node)
    kept = F.filter(inside, lambda n: n["text"].isNotNull() & ~(n["dropped"] & F.lit(clean)))
    return F.filter(F.transform(kept, lambda n: strip(n["text"])), lambda t: t != "")


def text_of(nodes: Column, node: Column, separator: str = " ", clean: bool = False) -> Column:
    return F.array_join(strings(nodes, node, clean), separator)


def raw_text(nodes: Column, node: Column) -> Column:
    """Unstripped text below an element, as for a script."""
    held = F.filter(subtree(nodes, node), lambda n: n["text"].isNotNull())
    return F.array_join(F.transform(held, lambda n: n["text"]), "")


def anchors(nodes: Column) -> Column:
    """Links of a page: ``array<struct<href, text>>`` in document order."""
    found = F.filter(nodes, lambda n: (n["tag"] == "a") & (strip(attribute(n, "href")) != ""))
    return F.transform(
        found, lambda n: F.struct(strip(attribute(n, "href")).alias("href"), text_of(nodes, n).alias("text"))
    )


# Scripts, styles and comments hold no links, whatever they look like; quoted values may hold any sign.
_NOT_MARKUP = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
_QUOTED = r"(?:\"[^\"]*\"|'[^']*')"
_ANCHOR = rf"(?is)<a(?=\s)(?:[^>\"']*?{_QUOTED})*?[^>\"']*?\shref\s*=\s*({_QUOTED}|[^\s\"'>]+)"
_ANCHOR_TEXT = rf"{_ANCHOR}(?:[^>\"']*{_QUOTED})*[^>\"']*>(.*?)(?=</a\b|<a\s|\z)"
_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def anchor_targets(html: Column) -> Column:
    """Link targets straight from markup, without parsing it: quoted in any way, references decoded."""
    found = F.regexp_extract_all(F.regexp_replace(html, _NOT_MARKUP, ""), F.lit(_ANCHOR), 1)
    return F.filter(F.transform(found, _target), lambda h: h != "")


def bare_anchors(html: Column) -> Column:
    """Links with their text straight from markup: ``array<struct<href, text>>`` in document order."""

    def pairs(shown: Column) -> Column:
        hrefs, inner = (F.regexp_extract_all(shown, F.lit(_ANCHOR_TEXT), i) for i in (1, 2))
        return F.filter(F.zip_with(hrefs, inner, lambda h, t: F.struct(_target(h).alias("href"), _line(t).alias("text"))), lambda a: a["href"] != "")

    return let(F.regexp_replace(html, _NOT_MARKUP, ""), pairs)


def _target(quoted: Column) -> Column:
    return unescape(strip(F.regexp_replace(quoted, r"^[\"']|[\"']$", "")))


def _line(markup: Column) -> Column:
    return unescape(strip(F.regexp_replace(F.regexp_replace(markup, r"<[^>]*>", " "), r"\s+", " ")))


def unescape(value: Column) -> Column:
    """Character references, named and numbered, each decoded once."""
    table = F.from_json(F.lit(_entity_table()), "map<string,string>")

    def number(reference: Column) -> Column:
        digits = F.when(reference.rlike("^#[xX]"), F.substr(reference, F.lit(3))).otherwise(F.conv(F.substr(reference, F.lit(2)), 10, 16))
        return F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")

    def sign(reference: Column) -> Column:
        named = F.try_element_at(table, reference)
        return F.when(reference.startswith("#"), number(reference)).otherwise(F.coalesce(named, F.concat(F.lit("&"), reference, F.lit(";"))))

    def decoded(text: Column) -> Column:
        signs = F.concat(F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), 1), sign), F.array(F.lit("")))
        return F.array_join(F.zip_with(F.split(text, _REFERENCE, -1), signs, lambda a, b: F.concat(a, b)), "")

    return F.when(value.contains("&"), decoded(value)).otherwise(value)


@lru_cache(maxsize=1)
def _entity_table() -> str:
    """Python's table of named references as JSON: a constant of the plan."""
    return json.dumps({name[:-1]: sign for name, sign in html5.items() if name.endswith(";")})


def has_heading(html: Column) -> Column:
    return F.coalesce(html.rlike(r"(?i)<h[1-6][\s>]"), F.lit(False))


# --- main content ---------------------------------------------------------------------------

SPAN = "struct<pre:int,stop:int,selector:string>"


def _span(node: Column, label) -> Column:
    name = F.lit(label) if isinstance(label, str) else label
    return F.when(
        node.isNotNull(),
        F.struct(node["pre"].alias("pre"), node["stop"].alias("stop"), name.alias("selector")),
    )


def _text_length(nodes: Column, node: Column) -> Column:
    """Characters of the kept text below an element."""
    return F.get(nodes, node["stop"] - 1)["text_sum"] - F.get(nodes, node["pre"])["text_sum"]


def _markup_length(nodes: Column, node: Column) -> Column:
    """Characters of the kept markup of an element, its own tags included."""
    return F.get(nodes, node["stop"] - 1)["size_sum"] - F.get(nodes, node["pre"])["size_sum"] + node["size"]


def _live(nodes: Column, selector: str) -> Column:
    return F.try_element_at(F.filter(matching(nodes, selector), lambda n: ~n["dropped"]), F.lit(1))


def _densest(nodes: Column) -> Column:
    """Container with the highest text length times text density, each measured in constant time."""
    boxes = F.filter(nodes, lambda n: n["tag"].isin("div", "section", "article", "main", "td") & ~n["dropped"])

    def score(box: Column) -> Column:
        return let(
            _text_length(nodes, box),
            lambda n: F.struct(
                F.when(n >= 100, n.cast("double") * n / _markup_length(nodes, box)).alias("score"), (-box["pre"]).alias("order"),
                box["pre"].alias("pre"), box["stop"].alias("stop"),
            ),
        )

    return F.array_max(F.filter(F.transform(boxes, score), lambda b: b["score"].isNotNull()))


def _semantic(nodes: Column, selector: str) -> Column:
    """First element of a semantic container, when it holds more than 50 characters."""
    return let(
        _live(nodes, selector),
        lambda n: F.when(_text_length(nodes, n) > 50, _span(n, f"semantic:{selector}")),
    )


def main_span(nodes: Column, platform: Column | None = None, resource_type: Column | None = None) -> Column:
    """Interval of the main content and how it was found."""
    choices = []
    if platform is not None:
        for name, rules in specs.MAIN_SELECTORS.items():
            named = F.lit(False)
            for kind, selector in rules.items():
                if kind != "default":
                    test = (platform == name) & (resource_type == kind)
                    named = named | (resource_type == kind)
                    choices.append(F.when(test, _span(_live(nodes, selector), f"platform:{selector}")))
            choices.append(
                F.when(
                    (platform == name) & ~named, _span(_live(nodes, rules["default"]), f"platform:{rules['default']}")
                )
            )
    choices += [_semantic(nodes, selector) for selector in ("article", "main", "[role=main]")]
    choices.append(_span(_densest(nodes), "density_analysis"))
    choices.append(_span(_live(nodes, "body"), "fallback:body"))
    whole = F.struct(
        F.lit(-1).alias("pre"), F.size(nodes).alias("stop"), F.lit("fallback:full_document").alias("selector")
    )
    return F.coalesce(*choices, whole)


def noise_removed(nodes: Column) -> Column:
    """How many subtrees were taken out as noise."""
    roots = F.filter(
        nodes,
        lambda n: n["tag"].isNotNull() & n["dropped"]
        & ((n["parent"] < 0) | ~F.element_at(nodes, F.greatest(n["parent"] + 1, F.lit(1)))["dropped"]),
    )
    return F.size(roots)
