"""Structured fields from API payloads (JSON text) and Atom entries (XML text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import text as X
from pagemill.functions.arrays import let
from pagemill.functions.json_rows import first_at, listed_objects, scalar_rows
from pagemill.functions.values import blank_to_null, first_text, last_wins

# --- JSON ------------------------------------------------------------------------------------


def at(payload: Column, path: str) -> Column:
    """Value at a path as text; NULL when any step is missing."""
    return F.get_json_object(payload, path)


def filled(value: Column) -> Column:
    """NULL for an empty string, array or object."""
    return F.when(~value.isin("", "[]", "{}", "null"), value)


def as_map(payload: Column) -> Column:
    return F.from_json(payload, "map<string,string>")


def generic_json(payload: Column) -> Column:
    """Title and description of an unknown JSON document, with their source."""
    title = first_text(at(payload, "$.title"), at(payload, "$.name"), at(payload, "$.data.title"))
    description = first_text(at(payload, "$.description"), at(payload, "$.summary"), at(payload, "$.data.description"))
    sources = F.map_filter(
        F.create_map(
            F.lit("title"), F.when(title.isNotNull(), F.lit("api_json")),
            F.lit("description"), F.when(description.isNotNull(), F.lit("api_json")),
        ),
        lambda _, v: v.isNotNull(),
    )
    return F.struct(title.alias("title"), description.alias("description"), sources.alias("field_sources"))


def render_document(title: Column, description: Column, fields: Column) -> Column:
    """Structured fields as text and markdown: ``struct<plain_text, markdown>``."""
    scalars = F.filter(
        F.map_entries(fields), lambda e: e["value"].isNotNull() & (e["value"] != "") & ~e["value"].rlike(r"^\s*[\[{]")
    )
    head = F.array(blank_to_null(title), blank_to_null(description))
    marked = F.array(F.concat(F.lit("# "), blank_to_null(title)), blank_to_null(description))
    plain = F.transform(scalars, lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    bold = F.transform(scalars, lambda e: F.concat(F.lit("**"), e["key"], F.lit("**: "), e["value"]))
    return F.struct(
        F.array_join(F.concat(head, plain), "\n\n").alias("plain_text"),
        F.array_join(F.concat(marked, bold), "\n\n").alias("markdown"),
    )


def rpc_document(payload: Column, heading: Column) -> Column:
    """Chain RPC answer: its result as text and as fenced markdown."""
    result = F.coalesce(at(payload, "$.result"), payload)
    return F.struct(
        result.alias("plain_text"),
        F.concat(F.lit("# "), heading, F.lit("\n\n```json\n"), result, F.lit("\n```")).alias("markdown"),
    )


def encyclopedia_document(payload: Column) -> Column:
    """First page of an encyclopedia API answer."""
    page = F.try_element_at(F.map_values(F.from_json(at(payload, "$.query.pages"), "map<string,string>")), F.lit(1))
    categories = F.transform(
        F.from_json(at(page, "$.categories"), "array<struct<title:string>>"),
        lambda c: F.regexp_replace(c["title"], "^Category:", ""),
    )
    return F.struct(
        at(page, "$.title").alias("title"),
        at(page, "$.pageid").alias("page_id"),
        F.coalesce(at(page, "$.extract"), F.lit("")).alias("plain_text"),
        F.coalesce(categories, F.array().cast("array<string>")).alias("categories"),
        X.strip(at(page, "$.pageprops['wikibase-shortdesc']")).alias("description"),
    )


# --- entity graphs -----------------------------------------------------------------------------


def graph_items(payload: Column) -> Column:
    """Every object in an ``included`` or ``elements`` list at any depth, as JSON text."""
    return listed_objects(payload, "included", "elements")


def _type_of(item: Column) -> Column:
    return F.coalesce(
        first_text(at(item, "$['$type']"), at(item, "$._type"), at(item, "$['$recipeType']"), at(item, "$._recipeType")), F.lit("")
    )


def _richness(item: Column) -> Column:
    values = F.map_values(as_map(item))
    return F.size(F.filter(values, lambda v: v.isNotNull() & ~v.isin("", "[]", "{}")))


def richest(items: Column, wanted) -> Column:
    """Item with the most filled values among those ``wanted``; the earliest one on a tie."""
    ranked = F.transform(
        items, lambda x, i: F.struct(F.when(wanted(x), _richness(x)).alias("n"), (-i).alias("o"), x.alias("item"))
    )
    best = F.array_max(F.filter(ranked, lambda r: r["n"].isNotNull()))
    return F.coalesce(best["item"], F.lit("{}"))


def of_type(*keywords: str):
    def test(item: Column) -> Column:
        kind = _type_of(item)
        hit = F.lit(False)
        for word in keywords:
            hit = hit | kind.contains(word)
        return hit

    return test


def is_company(item: Column) -> Column:
    urn = F.coalesce(at(item, "$.entityUrn"), F.lit(""))
    shaped = first_text(at(item, "$.name")).isNotNull() & (
        first_text(at(item, "$.universalName")).isNotNull()
        | urn.startswith("urn:li:fs_normalized_company:")
        | urn.startswith("urn:li:fsd_company:")
    )
    return of_type("Company", "Organization")(item) | shaped


def urn_tail(urn: Column) -> Column:
    return F.when(urn.contains(":"), F.element_at(F.split(urn, ":"), -1))


def by_urn(items: Column, urn: Column) -> Column:
    """The item another one refers to."""
    return F.try_element_at(F.filter(items, lambda x: at(x, "$.entityUrn") == urn), F.lit(1))


def entity_label(items: Column, urn: Column) -> Column:
    return let(
        by_urn(items, urn),
        lambda x: first_text(at(x, "$.defaultLocalizedName"), at(x, "$.localizedName"), at(x, "$.abbreviatedLocalizedName")),
    )


def localized(payload: Column) -> Column:
    """Text in the preferred language, else in the first one."""
    texts = F.from_json(at(payload, "$.localized"), "map<string,string>")
    wanted = F.concat_ws("_", at(payload, "$.preferredLocale.language"), at(payload, "$.preferredLocale.country"))
    return F.coalesce(F.try_element_at(texts, wanted), F.try_element_at(F.map_values(texts), F.lit(1)))


def epoch_text(value: Column) -> Column:
    """Epoch seconds or milliseconds as ISO-8601 in UTC."""
    number = F.try_to_number(value, F.lit("9999999999999999")).cast("double")
    seconds = F.when(number > 1e12, number / 1000).otherwise(number)
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ssXXX")


def logo(company: Column) -> Column:
    """Address of the widest logo."""
    image = F.coalesce(at(company, "$.logo.image"), at(company, "$.logos.logo"))
    image = F.coalesce(at(image, "$['com.linkedin.common.VectorImage']"), image)
    artifacts = F.from_json(at(image, "$.artifacts"), "array<struct<width:int,fileIdentifyingUrlPathSegment:string>>")
    best = F.array_max(
        F.transform(
            artifacts,
            lambda a, i: F.struct(F.coalesce(a["width"], F.lit(0)).alias("w"), (-i).alias("o"), a["fileIdentifyingUrlPathSegment"].alias("p")),
        )
    )
    return F.when(best.isNotNull(), F.concat(first_text(at(image, "$.rootUrl")), F.coalesce(best["p"], F.lit(""))))


def _label_of_first(payload: Column, name: str) -> Column:
    first = at(payload, f"$.{name}[0]")
    return F.when(
        F.startswith(first, F.lit("{")), first_text(at(first, "$.localizedName"), at(first, "$.name"))
    ).otherwise(first)


def company(items: Column) -> Column:
    """Company fields of an entity graph."""

    def project(c: Column) -> Column:
        place = first_text(at(c, "$.groupedLocationsByCountry[0].localizedName"), at(c, "$.groupedLocations[0].localizedName"), at(c, "$.headquarter.city"))
        follow = first_text(at(c, "$['*followingInfo']"), at(c, "$['*followingState']"), at(c, "$.dashFollowingStateUrn"))
        followers = F.coalesce(at(c, "$.followingInfo.followerCount"), at(by_urn(items, follow), "$.followerCount"))
        return F.struct(
            urn_tail(first_text(at(c, "$.dashEntityUrn"), at(c, "$.entityUrn"))).alias("source_id"),
            at(c, "$.name").alias("title"),
            F.coalesce(
                first_text(at(c, "$.description"), localized(at(c, "$.multiLocaleDescriptions")), at(c, "$.tagline")), F.lit("")
            ).alias("description"),
            at(c, "$.universalName").alias("company_slug"),
            F.coalesce(_label_of_first(c, "industries"), _label_of_first(c, "companyIndustries")).alias("industry"),
            at(c, "$.staffCount").cast("bigint").alias("staff_count"),
            at(c, "$.staffCountRange.start").cast("bigint").alias("staff_count_range_start"),
            place.alias("headquarters"),
            followers.cast("bigint").alias("follower_count"),
            logo(c).alias("logo_url"),
            at(c, "$.companyPageUrl").alias("website_url"),
            F.coalesce(F.from_json(at(c, "$.specialities"), "array<string>"), F.array().cast("array<string>")).alias("specialties"),
        )

    return let(richest(items, is_company), project)


def profile(items: Column) -> Column:
    """Person fields of an entity graph."""

    def project(p: Column) -> Column:
        names = F.filter(F.array(at(p, "$.firstName"), at(p, "$.lastName")), lambda x: F.coalesce(x, F.lit("")) != "")
        return F.struct(
            urn_tail(at(p, "$.entityUrn")).alias("source_id"),
            blank_to_null(X.strip(F.array_join(names, " "))).alias("title"),
            F.coalesce(at(p, "$.headline"), F.lit("")).alias("headline"),
            at(p, "$.publicIdentifier").alias("public_identifier"),
        )

    return let(richest(items, of_type("Profile")), project)


def job(items: Column) -> Column:
    """Job-posting fields of an entity graph, references resolved within the graph."""

    def project(j: Column, c: Column) -> Column:
        described = at(j, "$.description")
        text = F.when(F.startswith(described, F.lit("{")), at(j, "$.description.text")).otherwise(described)
        employer = first_text(at(c, "$.entityUrn"), at(j, "$.companyDetails.jobCompany['*company']"))
        return F.struct(
            urn_tail(at(j, "$.entityUrn")).alias("source_id"),
            at(j, "$.title").alias("title"),
            F.coalesce(text, F.lit("")).alias("description"),
            first_text(at(c, "$.name"), at(j, "$.companyDetails.name")).alias("company_name"),
            urn_tail(employer).alias("company_id"),
            entity_label(items, at(j, "$['*location']")).alias("location"),
            epoch_text(F.coalesce(at(j, "$.listedAt"), at(j, "$.originalListedAt"))).alias("published_at"),
            entity_label(items, at(j, "$['*employmentStatus']")).alias("employment_type"),
        )

    return let(
        richest(items, of_type("JobPosting")),
        lambda j: let(richest(items, of_type("Company", "Organization")), lambda c: project(j, c)),
    )


NETWORK_DOCUMENT = "title string, plain_text string, markdown string, entity_type string, source_id string, published_at string, structured string"


def network_document(payload: Column, kind: Column, fallback_title: Column) -> Column:
    """A network payload as a document: company, profile and job answers by their projection, others as they are.

    Only the row's own projection is computed. Without a title ``fallback_title`` counts; without text the payload itself.
    """

    def shaped(title: Column, text: Column, entity: str, source: Column, published: Column, structured: Column) -> Column:
        titled = blank_to_null(title).isNotNull() | blank_to_null(text).isNotNull()
        marked = X.strip(F.concat(F.lit("# "), F.coalesce(title, F.lit("None")), F.lit("\n\n"), text))
        return F.struct(
            title.alias("title"), text.alias("plain_text"), F.when(titled, marked).alias("markdown"), F.lit(entity).cast("string").alias("entity_type"),
            source.alias("source_id"), published.alias("published_at"), F.to_json(structured).alias("structured"),
        )

    none = F.lit(None).cast("string")

    def routed(items: Column) -> Column:
        return (
            F.when(kind == "company", let(company(items), lambda c: shaped(c["title"], c["description"], "organization", c["source_id"], none, c)))
            .when(kind == "profile", let(profile(items), lambda p: shaped(p["title"], p["headline"], "person", p["source_id"], none, p)))
            .when(kind == "job", let(job(items), lambda j: shaped(j["title"], j["description"], "job", j["source_id"], j["published_at"], j)))
            .otherwise(F.struct(none, payload, F.concat(F.lit("```json\n"), payload, F.lit("\n```")), none, none, none, F.lit("{}")).cast(f"struct<{NETWORK_DOCUMENT.replace(' string', ':string')}>"))
        )

    def whole(d: Column) -> Column:
        title, text = first_text(d["title"], fallback_title), first_text(d["plain_text"], payload)
        plain_mark = X.strip(F.concat(F.lit("# "), F.coalesce(title, F.lit("None")), F.lit("\n\n"), text))
        return F.struct(
            title.alias("title"), text.alias("plain_text"), first_text(d["markdown"], plain_mark).alias("markdown"),
            d["entity_type"].alias("entity_type"), d["source_id"].alias("source_id"), d["published_at"].alias("published_at"), d["structured"].alias("structured"),
        )

    return let(let(graph_items(payload), routed), whole)


def profile_urn(items: Column) -> Column:
    """Person key: an item with the person prefix, else the richest profile."""
    urns = F.transform(items, lambda x: at(x, "$.entityUrn"))
    direct = F.try_element_at(F.filter(urns, lambda u: u.startswith("urn:li:fsd_profile:")), F.lit(1))
    return F.coalesce(direct, at(richest(items, of_type("Profile")), "$.entityUrn"))


def company_id(items: Column) -> Column:
    """Company key: an item with the company prefix, else the company item, else a nested reference."""
    urns = F.transform(items, lambda x: at(x, "$.entityUrn"))
    direct = F.try_element_at(F.filter(urns, lambda u: u.startswith("urn:li:fsd_company:")), F.lit(1))
    best = richest(items, is_company)
    nested = F.filter(
        F.transform(items, lambda x: urn_tail(first_text(at(x, "$['*entityResult']"), at(x, "$['*organizationalTarget']")))),
        lambda u: u.isNotNull(),
    )
    return F.coalesce(
        urn_tail(direct), urn_tail(first_text(at(best, "$.entityUrn"), at(best, "$.dashEntityUrn"))), F.try_element_at(nested, F.lit(1))
    )


# --- prices and variants in embedded product JSON ----------------------------------------------

# Where an object may hold a product's price, the first one that it has counts.
PRICE_PATHS = (
    ("priceToPay", "price"), ("priceToPay", "displayPrice"), ("dealPrice", "price"),
    ("apexPriceToPay", "price"), ("apexPriceToPay", "displayPrice"), ("price",), ("displayPrice",),
)


def embedded_objects(script: Column) -> Column:
    """JSON objects handed to ``parseJSON('...')`` in script text."""
    found = F.regexp_extract_all(script, F.lit(r"(?s)parseJSON\('(\{.*?\})'\)"), 1)
    return F.filter(found, lambda j: F.try_parse_json(j).isNotNull())


def _as_list(objects: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.coalesce(objects, F.array().cast("array<string>")), ","), F.lit("]"))


def embedded_price(objects: Column) -> Column:
    """The price of a list of JSON objects, from the outermost and earliest object that has one."""
    return let(scalar_rows(_as_list(objects)), lambda rows: first_at(rows, PRICE_PATHS))


def embedded_variants(objects: Column) -> Column:
    """Distinct (product, label) pairs of every ``colorToAsin`` entry, given as text, as an object with ``asin``, or as JSON
    within a string."""

    def step(r: Column, back: int) -> Column:
        return F.try_element_at(r["path"], F.lit(-back))

    def pair(asin: Column, label: Column) -> Column:
        return F.struct(F.trim(asin).alias("asin"), F.trim(label).alias("label"))

    def within(r: Column) -> Column:
        entries = F.map_entries(F.from_json(r["value"], "map<string,string>"))
        return F.transform(entries, lambda e: pair(F.when(F.startswith(e["value"], F.lit("{")), at(e["value"], "$.asin")).otherwise(e["value"]), e["key"]))

    def pairs(r: Column) -> Column:
        found = (
            F.when(step(r, 1) == "colorToAsin", within(r))
            .when(step(r, 2) == "colorToAsin", F.array(pair(r["value"], step(r, 1))))
            .when((step(r, 3) == "colorToAsin") & (step(r, 1) == "asin"), F.array(pair(r["value"], step(r, 2))))
        )
        return F.when(r["kind"] == "string", found)

    def chosen(rows: Column) -> Column:
        found = F.flatten(F.filter(F.transform(rows, pairs), lambda p: p.isNotNull()))
        return F.array_distinct(F.filter(found, lambda p: (p["asin"] != "") & (p["label"] != "")))

    return let(scalar_rows(_as_list(objects)), chosen)


VARIANT_SLOT = "asin string, price string, available string, markup string"


def variant_slots(response_bodies: Column) -> Column:
    """``&&&``-separated variant objects as ``array<struct<asin, price, available, markup>>``; markup is the HTML that an
    answer brings along."""
    parts = F.flatten(F.transform(response_bodies, lambda b: F.split(b, "&&&")))
    slot = "$.Value.content.twisterSlotJson"
    valid = F.filter(parts, lambda p: (F.coalesce(X.strip(at(p, "$.ASIN")), F.lit("")) != "") & F.startswith(at(p, slot), F.lit("{")))
    return F.transform(valid, lambda p: F.struct(
        X.strip(at(p, "$.ASIN")).alias("asin"), filled(at(p, f"{slot}.price")).alias("price"), at(p, f"{slot}.isAvailable").alias("available"),
        F.coalesce(at(p, "$.Value.content.twisterSlotDiv"), F.lit("")).alias("markup"),
    ))


def variant_states(slots: Column, shown_prices: Column) -> Column:
    """Slots as ``map<product, struct<price, availability>>``; a price that the slot's markup shows stands before the bare one,
    and the last answer for a product counts."""

    def state(slot: Column, shown: Column) -> Column:
        price = F.when(slot["price"].isNotNull(), first_text(shown, slot["price"]))
        known = F.when(slot["available"] == "true", F.lit("In Stock")).when(slot["available"] == "false", F.lit("Unavailable"))
        return F.struct(slot["asin"].alias("key"), F.struct(price.alias("price"), known.alias("availability")).alias("value"))

    states = F.zip_with(slots, shown_prices, state)
    return last_wins(F.filter(states, lambda s: s["value"]["price"].isNotNull() | s["value"]["availability"].isNotNull()))


# --- Atom -------------------------------------------------------------------------------------

ENTRY = "(//*[local-name()='entry' or name()='entry'])[1]"


def _named(name: str) -> str:
    return f"*[name()='{name}' or local-name()='{name}']"


def _entry_text(xml: Column, name: str) -> Column:
    return blank_to_null(X.collapse(F.xpath_string(xml, F.lit(f"{ENTRY}/{_named(name)}"))))


def _entry_list(xml: Column, path: str) -> Column:
    found = F.xpath(xml, F.lit(f"{ENTRY}/{path}"))
    return F.filter(F.transform(found, X.collapse), lambda x: x.isNotNull() & (x != ""))


def paper(xml: Column, url: Column) -> Column:
    """Paper fields of the first Atom entry and what is derived from them."""
    base = F.struct(
        _entry_text(xml, "title").alias("title"), _entry_text(xml, "summary").alias("summary"),
        _entry_list(xml, f"{_named('author')}/{_named('name')}/text()").alias("authors"),
        _entry_list(xml, f"{_named('category')}/@term").alias("categories"),
        blank_to_null(X.strip(F.xpath_string(xml, F.lit(f"{ENTRY}/{_named('arxiv:primary_category')}/@term")))).alias("primary"),
        blank_to_null(X.strip(F.xpath_string(xml, F.lit(f"({ENTRY}/{_named('link')}[@type='application/pdf'])[1]/@href")))).alias("pdf_url"),
    )
    return let(base, lambda b: _paper(xml, url, b))


def _paper(xml: Column, url: Column, b: Column) -> Column:
    full = F.coalesce(b["summary"], F.lit(""))
    markdown = F.when(
        b["title"].isNotNull() | b["summary"].isNotNull(),
        X.strip(F.concat(F.lit("# "), F.coalesce(b["title"], F.lit("")), F.lit("\n\n## Abstract\n\n"), full)),
    ).otherwise(F.lit(""))
    own = F.split(F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1), "v")[0]
    urls = X.urls_in(markdown)
    code = F.filter(urls, lambda u: F.lower(u).contains("github.com"))
    data = F.filter(urls, lambda u: ~F.lower(u).contains("github.com"))
    references = X.reference_lines(markdown)
    related = F.filter(X.paper_ids_in(markdown), lambda p: F.split(p, "v")[0] != own)
    return F.struct(
        b["title"].alias("title"), b["summary"].alias("description"), _entry_text(xml, "arxiv:doi").alias("doi"),
        b["authors"].alias("authors"), F.transform(b["authors"], X.author_name).alias("authors_structured"),
        b["categories"].alias("categories"), b["primary"].alias("primary_category"),
        _entry_text(xml, "published").alias("published"), _entry_text(xml, "updated").alias("updated"),
        _entry_text(xml, "id").alias("entry_id"), b["pdf_url"].alias("pdf_url"), full.alias("raw_text"),
        X.strip_latex(b["title"]).alias("title_normalized"), X.strip_latex(b["summary"]).alias("abstract_plain_text"),
        X.category_path(b["categories"], b["primary"]).alias("topic_hierarchy"),
        X.category_name(b["primary"]).alias("research_area_plain_english"),
        X.markdown_sections(markdown).alias("sections_structured"), references.alias("references"),
        F.size(references).alias("total_citation_count"),
        (F.size(code) > 0).alias("code_available"), F.try_element_at(code, F.lit(1)).alias("code_url"),
        (F.size(data) > 0).alias("dataset_released"), F.try_element_at(data, F.lit(1)).alias("dataset_url"),
        F.lit("open_access").alias("open_access_status"), urls.alias("project_urls"), related.alias("related_paper_ids"),
        markdown.alias("markdown"),
    )
