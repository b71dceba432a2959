"""Address rules of the supported platforms: normalise, classify, infer, discover."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import url as U
from pagemill.functions.arrays import let
from pagemill.functions.text import strip

HEX = r"(0x[a-fA-F0-9]+)"
PAPER_ID = r"([a-zA-Z\-]+/\d{7}|\d{4}\.\d{4,5})"

# Address shapes.
PRODUCT_PATTERNS = (
    r"(?i)amazon\.com/dp/([A-Z0-9]{10})",
    r"(?i)amazon\.com/gp/product/([A-Z0-9]{10})",
    r"(?i)amazon\.com/[^/]+/dp/([A-Z0-9]{10})",
    r"(?i)amazon\.com/exec/obidos/ASIN/([A-Z0-9]{10})",
)
DATA_ASIN = r"(?i)data-asin=[\"']([A-Z0-9]{10})[\"']"
NETWORK_ADDRESS = r"(?i)(https?://(?:[\w-]+\.)*linkedin\.com[^\s)\"'<>]*)"
NETWORK_HELP_HOSTS = (
    "about.linkedin.com",
    "business.linkedin.com",
    "careers.linkedin.com",
    "mobile.linkedin.com",
    "safety.linkedin.com",
)
NETWORK_NAV_PREFIXES = (
    "/mynetwork", "/notifications", "/messaging", "/help/", "/legal/", "/accessibility",
    "/mypreferences", "/ad/", "/jobs/?",
)


def _result(entity: Column, canonical: Column, key: Column, value: Column, original: Column, notes: Column) -> Column:
    known = entity != "unknown"
    identity = F.when(known, F.create_map(F.coalesce(key, F.lit("")), value)).otherwise(
        F.create_map().cast("map<string,string>")
    )
    return F.struct(
        entity.alias("entity_type"),
        F.when(known, canonical).otherwise(F.lit("")).alias("canonical_url"),
        identity.alias("identity"),
        original.alias("original_url"),
        notes.cast("array<string>").alias("notes"),
    )


def _texts(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _first_branch(found: Column, branches, notes: Column) -> tuple[Column, ...]:
    """Entity, address, identity and notes of the first branch whose value is not empty."""
    entity, canonical = F.lit("unknown"), F.lit("")
    key, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, kind, field, address, note in reversed(branches):
        hit = found[name] != ""
        entity = F.when(hit, F.lit(kind)).otherwise(entity)
        canonical = F.when(hit, address(found[name])).otherwise(canonical)
        key = F.when(hit, F.lit(field)).otherwise(key)
        value = F.when(hit, found[name]).otherwise(value)
        notes = F.when(hit, note).otherwise(notes)
    return entity, canonical, key, value, notes


def _network_address(prefix: str, encode: bool = False):
    def build(value: Column) -> Column:
        shown = U.percent_encode(value, "") if encode else value
        return F.concat(F.lit("https://www.linkedin.com" + prefix), shown, F.lit("/"))

    return build


def normalize_network(url: Column) -> Column:
    """Professional-network address -> profile, company, job, post or unknown."""
    return let(strip(F.coalesce(url, F.lit(""))), _network_from_raw)


def _network_from_raw(raw: Column) -> Column:
    full = F.when(U.scheme(raw) == "", F.concat(F.lit("https://"), raw)).otherwise(raw)
    parts = F.struct(
        U.scheme(full).alias("scheme"),
        F.substring_index(F.lower(U.authority(full)), ":", 1).alias("host"),
        F.concat(F.lit("/"), F.ltrim(U.percent_decode(U.path(full)), F.lit("/")), F.lit("/")).alias("path"),
        (U.query(full) != "").alias("asked"),
    )
    return let(parts, lambda p: let(_network_ids(p), lambda found: _network_result(raw, p, found)))


def _network_ids(parts: Column) -> Column:
    place = F.regexp_replace(parts["path"], "/+$", "/")
    low = F.lower(place)

    def segment(pattern: str) -> Column:
        return F.regexp_extract(place, pattern, 1)

    return F.struct(
        strip(U.percent_decode(segment(r"(?i)^/in/([^/]+)/"))).alias("profile"),
        strip(U.percent_decode(segment(r"(?i)^/company/([^/]+)/"))).alias("company"),
        segment(r"(?i)^/jobs/view/(\d+)/?").alias("job"),
        segment(r"(?i)^/feed/update/urn:li:activity:(\d+)/?$").alias("activity"),
        F.when(
            low.contains("feed") & low.contains("activity"), segment(r"(?i)feed/update/.*?activity[:%3A]+(\d+)")
        ).otherwise(F.lit("")).alias("embedded"),
        F.when(place.contains("/posts/"), segment(r"(?i)activity-(\d+)(?:$|[-_/])")).otherwise(F.lit("")).alias("posted"),
    )


def _network_result(raw: Column, parts: Column, found: Column) -> Column:
    host = parts["host"]
    invalid = (
        F.when(raw == "", F.lit("empty_input"))
        .when(~parts["scheme"].isin("http", "https"), F.lit("unsupported_scheme"))
        .when((host != "linkedin.com") & ~host.endswith(".linkedin.com"), F.lit("not_linkedin_host"))
    )
    base = F.when(parts["asked"], _texts("stripped_query")).otherwise(_texts())

    def noted(text: str) -> Column:
        return F.concat(base, _texts(text))

    activity = _network_address("/feed/update/urn:li:activity:")
    branches = (
        ("profile", "profile", "vanity", _network_address("/in/", True), base),
        ("company", "company", "vanity", _network_address("/company/", True), base),
        ("job", "job", "job_id", _network_address("/jobs/view/"), base),
        ("activity", "post", "activity_id", activity, base),
        ("embedded", "post", "activity_id", activity, noted("decoded_embedded_activity_path")),
        ("posted", "post", "activity_id", activity, noted("normalized_from_posts_path")),
    )
    entity, canonical, key, value, notes = _first_branch(found, branches, noted("unrecognized_path"))
    return _result(
        F.when(invalid.isNotNull(), F.lit("unknown")).otherwise(entity), canonical, key, value, raw,
        F.when(invalid.isNotNull(), F.array(invalid)).otherwise(notes),
    )


def product_id(url: Column) -> Column:
    """Ten-character product number in an address, or NULL."""
    return F.upper(F.coalesce(*[F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in PRODUCT_PATTERNS]))


def is_product_id(value: Column) -> Column:
    return F.coalesce(F.upper(value).rlike(r"^[A-Z0-9]{10}$"), F.lit(False))


def product_address(asin: Column) -> Column:
    return F.concat(F.lit("https://www.amazon.com/dp/"), F.upper(asin))


def normalize_product(url: Column) -> Column:
    """Retail address -> ``/dp/{id}`` or unknown."""
    raw = strip(F.coalesce(url, F.lit("")))
    asin = product_id(raw)
    notes = (
        F.when(raw == "", _texts("empty_input"))
        .when(asin.isNull(), _texts("no_asin_found"))
        .otherwise(_texts())
    )
    entity = F.when(asin.isNull(), F.lit("unknown")).otherwise(F.lit("product"))
    return _result(entity, product_address(asin), F.lit("asin"), asin, raw, notes)


def normalize_article(url: Column) -> Column:
    """Encyclopedia address -> article on the English host; namespaced titles are unknown."""
    raw = strip(F.coalesce(url, F.lit("")))
    decoded = U.percent_decode(U.path(raw))
    title = F.replace(strip(F.regexp_extract(decoded, r"(?s)^/wiki/(.*)$", 1)), F.lit(" "), F.lit("_"))
    good = U.authority(raw).contains("wikipedia.org") & (title != "") & ~title.contains(":")
    entity = F.when(good, F.lit("article")).otherwise(F.lit("unknown"))
    return _result(entity, F.concat(F.lit("https://en.wikipedia.org/wiki/"), title), F.lit("title"), title, raw, _texts())


def normalize_paper(url: Column) -> Column:
    """Preprint abstract address -> paper without its version."""
    raw = strip(F.coalesce(url, F.lit("")))
    paper = F.regexp_extract(raw, r"(?i)^https?://(?:www\.)?arxiv\.org/abs/" + PAPER_ID, 1)
    entity = F.when(paper != "", F.lit("paper")).otherwise(F.lit("unknown"))
    return _result(entity, F.concat(F.lit("https://arxiv.org/abs/"), paper), F.lit("arxiv_id"), paper, raw, _texts())


def normalize_chain(url: Column) -> Column:
    """Chain-explorer address -> contract, token, transaction or address.

    Both ``/#code`` and ``#code`` mark a contract page, so template addresses round-trip.
    """

    def at(raw: Column, tail: str) -> Column:
        return F.regexp_extract(raw, r"(?i)^https?://(?:www\.)?basescan\.org/" + tail, 1)

    def address(place: str, tail: str = ""):
        return lambda value: F.concat(F.lit("https://basescan.org/" + place), value, F.lit(tail))

    branches = (
        ("contract", "contract", "contract_address", address("address/", "/#code"), _texts()),
        ("token", "token", "contract_address", address("token/"), _texts()),
        ("transaction", "transaction", "tx_hash", address("tx/"), _texts()),
        ("address", "address", "address", address("address/"), _texts()),
    )

    def from_raw(raw: Column) -> Column:
        ids = F.struct(
            at(raw, f"address/{HEX}/?#code").alias("contract"), at(raw, f"token/{HEX}").alias("token"),
            at(raw, f"tx/{HEX}").alias("transaction"), at(raw, f"address/{HEX}").alias("address"),
        )
        return let(ids, lambda found: result(raw, found))

    def result(raw: Column, found: Column) -> Column:
        entity, canonical, key, value, notes = _first_branch(found, branches, _texts())
        return _result(entity, canonical, key, value, raw, notes)

    return let(strip(F.coalesce(url, F.lit(""))), from_raw)


def normalize(platform: str, url: Column) -> Column:
    """Normaliser of one platform; an unknown platform leaves the address as it is."""
    rules = {
        "linkedin": normalize_network,
        "amazon": normalize_product,
        "wikipedia": normalize_article,
        "arxiv": normalize_paper,
        "base": normalize_chain,
    }
    if platform in rules:
        return rules[platform](url)
    return F.struct(
        F.lit("unknown").alias("entity_type"),
        url.alias("canonical_url"),
        F.create_map().cast("map<string,string>").alias("identity"),
        url.alias("original_url"),
        _texts().alias("notes"),
    )


def network_bucket(url: Column) -> Column:
    """One of nine buckets for a professional-network address."""
    return let(
        F.struct(U.scheme(url).alias("scheme"), U.percent_decode(U.path(url)).alias("path")),
        lambda u: let(F.filter(F.split(strip(u["path"]), "/", -1), lambda x: x != ""), lambda parts: _bucket(u, parts)),
    )


def _bucket(url: Column, parts: Column) -> Column:
    low = F.lower(url["path"])
    first = F.lower(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")))
    third = F.lower(F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("")))
    tab = (first == "company") & third.isin("jobs", "people", "posts", "life")
    profile = (F.size(parts) >= 2) & (first == "in")
    return (
        F.when(~url["scheme"].isin("http", "https"), F.lit("other"))
        .when(low.contains("/jobs/search"), F.lit("jobs_search"))
        .when(low.contains("/jobs/view/") | low.contains("/jobs/collections/"), F.lit("job"))
        .when(low.contains("/company/") & tab, F.lit("company_tab"))
        .when(low.contains("/company/"), F.lit("company"))
        .when(low.contains("feed/update") & low.contains("activity"), F.lit("post"))
        .when(low.contains("/posts/") & low.contains("activity-"), F.lit("post"))
        .when(profile & (F.size(parts) == 2), F.lit("profile"))
        .when(profile & (third == "recent-activity"), F.lit("profile_activity"))
        .when(profile, F.lit("profile_subpage"))
        .otherwise(F.lit("other"))
    )


def is_network_nav(url: Column) -> Column:
    """Global navigation, footer and help links."""
    host = F.lower(U.authority(url))
    place = F.lower(U.path(url))
    asked = F.lower(U.query(url))
    help_host = F.lit(False)
    for name in NETWORK_HELP_HOSTS:
        help_host = help_host | host.contains(name)
    nav = F.lit(False)
    for prefix in NETWORK_NAV_PREFIXES:
        nav = nav | place.startswith(prefix)
    feed = place.isin("/", "/feed", "/feed/") | (place.startswith("/feed") & asked.contains("nis="))
    return help_host | feed | nav | place.isin("/jobs", "/jobs/")


def infer_task(url: Column) -> Column:
    """Address -> struct(platform, resource_type, field, value); anything else is a generic page."""
    parts = F.struct(F.lower(U.authority(url)).alias("host"), U.path(url).alias("path"), url.alias("url"))
    return let(parts, lambda p: _task(p["host"], p["path"], p["url"]))


def _task(host: Column, place: Column, url: Column) -> Column:
    title = F.replace(U.percent_decode(F.regexp_extract(place, r"(?s)^/wiki/(.*)$", 1)), F.lit("_"), F.lit(" "))
    slash = F.lit("/")

    def network(pattern: str) -> Column:
        return F.when(host.endswith("www.linkedin.com"), F.regexp_extract(place, pattern, 1)).otherwise(F.lit(""))

    explorer = host.endswith("basescan.org") | host.endswith("base.org")
    product = F.regexp_extract(place, r"/dp/([A-Z0-9]{10})(?:/|$)", 1)
    rules = [
        (host.endswith("en.wikipedia.org") & place.startswith("/wiki/"), "wikipedia", "article", "title", title),
        (host.endswith("arxiv.org") & place.startswith("/abs/"), "arxiv", "paper", "arxiv_id",
         F.btrim(F.substring(place, 6, 2147483647), slash)),
    ]
    for pattern, kind, name in (
        (r"^/in/([^/]+)/?$", "profile", "public_identifier"),
        (r"^/company/([^/]+)/?$", "company", "company_slug"),
        (r"^/jobs/view/(\d+)/?$", "job", "job_id"),
        (r"^/feed/update/([^/]+)/?$", "post", "activity_urn"),
    ):
        found = network(pattern)
        rules.append((found != "", "linkedin", kind, name, found))
    rules.append((host.endswith("www.amazon.com") & (product != ""), "amazon", "product", "asin", product))
    for prefix, kind, name in (
        ("/address/", "address", "address"),
        ("/tx/", "transaction", "tx_hash"),
        ("/token/", "token", "contract_address"),
    ):
        rest = F.btrim(F.substring(place, len(prefix) + 1, 2147483647), slash)
        rules.append((explorer & place.startswith(prefix), "base", kind, name, rest))

    def out(platform: str, kind: str, name: str, value: Column) -> Column:
        return F.struct(
            F.lit(platform).alias("platform"), F.lit(kind).alias("resource_type"),
            F.lit(name).alias("field"), value.alias("value"),
        )

    result = out("generic", "page", "url", url)
    for test, platform, kind, name, value in reversed(rules):
        result = F.when(test, out(platform, kind, name, value)).otherwise(result)
    return result


# --- links in raw HTML, by pattern ---------------------------------------------------------


def _found(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), 1)


def paper_links(html: Column) -> Column:
    """Distinct abstract addresses in order of appearance."""
    ids = _found(html, r"(?i)/abs/" + PAPER_ID + r"(?:v\d+)?")
    return F.array_distinct(F.transform(ids, lambda x: F.concat(F.lit("https://arxiv.org/abs/"), x)))


def chain_links(html: Column) -> Column:
    """Distinct explorer addresses: all address links, then transactions, then tokens."""
    root = r"(?i)(https?://(?:www\.)?basescan\.org/"
    return F.array_distinct(
        F.concat(
            _found(html, root + r"address/0x[a-fA-F0-9]+(?:/#code|#code)?)"),
            _found(html, root + r"tx/0x[a-fA-F0-9]+)"),
            _found(html, root + r"token/0x[a-fA-F0-9]+)"),
        )
    )


def product_ids(html: Column) -> Column:
    """Sorted distinct product numbers from addresses and ``data-asin`` attributes."""
    every = F.concat(*[_found(html, p) for p in (*PRODUCT_PATTERNS, DATA_ASIN)])
    return F.array_sort(F.array_distinct(F.transform(every, F.upper)))


def related_products(html: Column, own: Column) -> Column:
    """Sorted product addresses in a page without the page's own product."""
    others = F.array_except(product_ids(html), F.array(F.coalesce(F.upper(own), F.lit(""))))
    return F.array_sort(F.transform(others, product_address))


def network_links(html: Column, anchors: Column) -> Column:
    """Anchor addresses first, then every address embedded anywhere in the page."""
    embedded = F.transform(
        _found(html, NETWORK_ADDRESS),
        lambda u: strip(U.without_fragment(F.rtrim(u, F.lit(".,;]")))),
    )
    return F.array_distinct(F.concat(anchors, F.filter(embedded, lambda u: u != "")))


def job_ids_in_search(url: Column) -> Column:
    """Job numbers named by the query of a job-search address, in order."""
    landing = F.flatten(F.transform(U.query_values(url, "originToLandingJobPostings"), U.split_list))
    every = F.concat(U.query_values(url, "currentJobId"), landing)
    return F.array_distinct(F.filter(every, lambda x: x.rlike(r"^\d+$")))


def job_addresses(ids: Column) -> Column:
    return F.array_sort(
        F.transform(ids, lambda x: F.concat(F.lit("https://www.linkedin.com/jobs/view/"), x, F.lit("/")))
    )
