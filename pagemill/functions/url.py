"""Address functions: RFC 3986 parts, joining, escaping, keys. No URL parser that rejects rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.text import strip

# scheme, authority, path, query, fragment
PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column) -> Column:
    """User info, host and port, as written."""
    return _part(url, 2)


def hostname(url: Column) -> Column:
    """Lower-case host without user info and port; empty when there is none."""
    return F.lower(F.regexp_extract(authority(url), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return F.substring(_part(url, 4), 2, 2147483647)


def fragment(url: Column) -> Column:
    return F.substring(_part(url, 5), 2, 2147483647)


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"(?s)#.*$", "")


def without_query(url: Column) -> Column:
    """Drop query and fragment."""
    return F.regexp_replace(url, r"(?s)[?#].*$", "")


def scope_key(url: Column) -> Column:
    """Text between ``//`` and the next slash; the whole value when there is no ``//``."""
    return F.when(url.contains("//"), F.regexp_extract(url, r"(?s)//([^/]*)", 1)).otherwise(url)


def url_key(platform: Column, url: Column) -> Column:
    return F.concat_ws(":", platform, url)


def percent_decode(value: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone; undecodable text stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)


def percent_encode(value: Column, safe: str = "/") -> Column:
    """Percent-encoding that keeps ASCII letters, digits, ``_.-~`` and ``safe``."""
    out = F.url_encode(value)
    for written, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(written), F.lit(wanted))
    for char in safe:
        if not (char.isalnum() or char in "_.-~"):
            out = F.replace(out, F.lit(f"%{ord(char):02X}"), F.lit(char))
    return out


def query_values(url: Column, name: str) -> Column:
    """All values of one query parameter, decoded, in order."""
    pairs = F.split(query(url), "&", -1)
    hits = F.filter(pairs, lambda p: p.startswith(f"{name}=") & (F.length(p) > len(name) + 1))
    return F.transform(
        hits,
        lambda p: F.coalesce(
            F.try_url_decode(F.substring(p, len(name) + 2, 2147483647)),
            F.substring(p, len(name) + 2, 2147483647),
        ),
    )


def _without_dots(segments: Column) -> Column:
    """Resolve ``.`` and ``..`` in a path given as segments (the first one is empty)."""
    last = F.element_at(segments, -1)
    inner = F.filter(
        segments, lambda s, i: (i == 0) | (i == F.size(segments) - 1) | (s != "")
    )
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        inner,
        empty,
        lambda acc, s: F.when(
            s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        )
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    joined = F.array_join(closed, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def join(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base``."""
    own_scheme = scheme(href)
    base_scheme = scheme(base)
    base_path = path(base)
    own_path = path(href)
    base_segments = F.split(base_path, "/", -1)
    folder = F.when(
        F.element_at(base_segments, -1) != "",
        F.slice(base_segments, 1, F.size(base_segments) - 1),
    ).otherwise(base_segments)
    segments = F.when(own_path.startswith("/"), F.split(own_path, "/", -1)).otherwise(
        F.concat(folder, F.split(own_path, "/", -1))
    )
    # A path without dots or empty segments needs no fold: the common case of a crawl.
    plain = own_path.startswith("/") & ~own_path.rlike(r"//|/\.{1,2}(?:/|$)")
    resolved = F.when(plain, own_path).otherwise(_without_dots(segments))
    root = F.concat(base_scheme, F.lit("://"), authority(base))
    tail = F.concat(_part(href, 4), _part(href, 5))
    same_page = F.concat(
        root, base_path,
        F.when(_part(href, 4) != "", _part(href, 4)).otherwise(_part(base, 4)), _part(href, 5),
    )
    relative = own_scheme.isin("http", "https") & (own_scheme == base_scheme) & (authority(href) == "")
    return (
        F.when(href == "", base)
        .when((own_scheme != "") & ~relative, href)
        .when(authority(href) != "", F.concat(base_scheme, F.lit(":"), href))
        .when(own_path == "", same_page)
        .otherwise(F.concat(root, resolved, tail))
    )


def has_web_scheme(url: Column) -> Column:
    return url.startswith("http://") | url.startswith("https://")


def split_list(value: Column) -> Column:
    """Comma-separated text as trimmed, non-empty items."""
    return F.filter(F.transform(F.split(value, ","), strip), lambda x: x != "")


def seed_address(domain: Column) -> Column:
    """Start address of a source domain; an encyclopedia root starts at its main page."""
    raw = strip(domain)
    full = F.when(raw.contains("://"), raw).otherwise(
        F.concat(F.lit("https://"), F.btrim(raw, F.lit("/")), F.lit("/"))
    )
    host = F.lower(F.when(authority(full) != "", authority(full)).otherwise(path(full)))
    is_root = F.rtrim(path(full), F.lit("/")) == ""
    start = F.when(scheme(full) == "", F.lit("https")).otherwise(scheme(full))
    return F.when(
        host.endswith(".wikipedia.org") & is_root,
        F.concat(start, F.lit("://"), host, F.lit("/wiki/Main_Page")),
    ).otherwise(full)
