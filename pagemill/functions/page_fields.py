"""Structured fields of a page from its node array: metadata, CSS schemas, platform pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions import payloads as J
from pagemill.functions import url as U
from pagemill.functions.arrays import first_occurrences, let
from pagemill.functions.text import strip
from pagemill.functions.values import blank_to_null, first_filled, first_text


def meta_content(nodes: Column, key: str, name: str) -> Column:
    """Content of the first ``<meta>`` with the given property or name."""
    found = F.filter(nodes, lambda n: (n["tag"] == "meta") & (H.attribute(n, key) == name))
    return blank_to_null(strip(H.attribute(F.try_element_at(found, F.lit(1)), "content")))


def page_title(nodes: Column) -> Column:
    found = F.try_element_at(F.filter(nodes, lambda n: n["tag"] == "title"), F.lit(1))
    return blank_to_null(strip(H.raw_text(nodes, found)))


def page_meta(nodes: Column, url: Column) -> Column:
    """Title, description, canonical address, type and image, with the source of each."""
    retail = F.lower(url).contains("amazon.")

    def branded(value: Column) -> Column:
        """A page of the retailer that only names the retailer says nothing."""
        return F.when(~(retail & (F.lower(value) == "amazon")), value)

    og_title = branded(meta_content(nodes, "property", "og:title"))
    og_text = branded(meta_content(nodes, "property", "og:description"))
    plain_title = page_title(nodes)
    plain_text = meta_content(nodes, "name", "description")
    link = F.try_element_at(
        F.filter(nodes, lambda n: (n["tag"] == "link") & F.array_contains(F.split(H.attribute(n, "rel"), r"\s+"), "canonical")),
        F.lit(1),
    )
    canonical = U.join(url, blank_to_null(H.attribute(link, "href")))
    kind = meta_content(nodes, "property", "og:type")
    image = U.join(url, meta_content(nodes, "property", "og:image"))
    sources = F.create_map(
        F.lit("title"), F.when(og_title.isNotNull(), F.lit("html_meta:og:title")).when(plain_title.isNotNull(), F.lit("html_meta:title")),
        F.lit("description"),
        F.when(og_text.isNotNull(), F.lit("html_meta:og:description")).when(plain_text.isNotNull(), F.lit("html_meta:description")),
        F.lit("canonical_url"), F.when(canonical.isNotNull(), F.lit("html_meta:canonical")),
        F.lit("og_type"), F.when(kind.isNotNull(), F.lit("html_meta:og:type")),
        F.lit("image_url"), F.when(image.isNotNull(), F.lit("html_meta:og:image")),
    )
    return F.struct(
        F.coalesce(og_title, plain_title).alias("title"), F.coalesce(og_text, plain_text).alias("description"),
        F.coalesce(canonical, url).alias("canonical_url"), kind.alias("og_type"), image.alias("image_url"),
        F.map_filter(sources, lambda _, v: v.isNotNull()).alias("field_sources"),
    )


# --- CSS schema --------------------------------------------------------------------------------


def css_values(nodes: Column, spec: dict, url: Column) -> Column:
    """Non-empty values of every node a field spec selects."""
    name = spec.get("attribute")

    def value(node: Column) -> Column:
        if not name:
            return H.text_of(nodes, node)
        held = strip(H.attribute(node, name))
        return U.join(url, held) if name in ("href", "src") else held

    found = F.transform(H.matching(nodes, spec["selector"]), value)
    return F.filter(found, lambda v: v.isNotNull() & (v != ""))


def css_source(spec: dict) -> str:
    return f"css:{spec['selector']}" + (f"@{spec['attribute']}" if spec.get("attribute") else "")


def css_fields(nodes: Column, schema: dict, url: Column) -> Column:
    """Fields of a CSS schema as ``map<field, array<string>>``; a single field has one value."""
    specs = {k: schema[k] for k in ("title", "description") if k in schema} | schema.get("fields", {})
    pairs = []
    for name, spec in specs.items():
        values = css_values(nodes, spec, url)
        pairs += [F.lit(name), values if spec.get("multiple") else F.slice(values, 1, 1)]
    return F.map_filter(F.create_map(*pairs), lambda _, v: F.size(v) > 0)


def css_sources(schema: dict, fields: Column) -> Column:
    specs = {k: schema[k] for k in ("title", "description") if k in schema} | schema.get("fields", {})
    labels = F.create_map(*[F.lit(x) for k, s in specs.items() for x in (k, css_source(s))])
    return F.map_filter(labels, lambda k, _: F.map_contains_key(fields, k))


# --- platform pages. The selectors and source labels. -----------------------------

PRODUCT_FIELDS = {
    "title": {"selector": "#productTitle"},
    "brand": {"selector": "#bylineInfo"},
    "brand_url": {"selector": "#bylineInfo", "attribute": "href"},
    "price": {
        "selector": "#corePrice_feature_div .a-offscreen, #corePrice_desktop .a-offscreen, "
        "#apex_desktop .a-offscreen, .a-price .a-offscreen"
    },
    "availability": {
        "selector": "#availability .a-color-success, #availability span, #availability_feature_div span.a-color-success, "
        "#outOfStock .a-color-price, #outOfStock .a-text-bold"
    },
    "rating": {"selector": "#averageCustomerReviews_feature_div .a-icon-alt, #acrPopover .a-icon-alt"},
    "reviews_count": {"selector": "#acrCustomerReviewText"},
    "category": {"selector": "#wayfinding-breadcrumbs_feature_div a", "multiple": True},
    "bullet_points": {"selector": "#feature-bullets .a-list-item", "multiple": True},
    "images": {"selector": "#imgTagWrapperId img[src], #altImages img[src]", "attribute": "src", "multiple": True},
    "description": {"selector": "#productDescription, #productDescription_feature_div, #bookDescription_feature_div"},
    "fulfillment": {
        "selector": "#mir-layout-DELIVERY_BLOCK-slot-PRIMARY_DELIVERY_MESSAGE_LARGE, #deliveryBlockMessage, "
        "#mir-layout-DELIVERY_BLOCK-slot-DELIVERY_MESSAGE, #exports_desktop_qualifiedBuybox_deliveryPromiseMessaging_feature_div"
    },
    "seller": {"selector": "#merchant-info"},
}
SELLER_FIELDS = {
    "seller_name": {"selector": "#seller-name, #seller-profile-container h1, h1"},
    "seller_rating": {"selector": "#seller-rating, #seller-info-feedback-summary, .seller-rating"},
    "feedback_count": {"selector": "#feedback-count, #seller-feedback-count, .feedback-count"},
    "seller_since": {"selector": "#seller-since, .seller-since"},
}
LISTING_FIELDS = {
    "title": ("a.seller-product-link[href], a[href*='/dp/']", None),
    "url": ("a.seller-product-link[href], a[href*='/dp/']", "href"),
    "price": (".a-price .a-offscreen, .seller-product-price", None),
    "rating": (".a-icon-alt, .seller-product-rating", None),
}
EXPLORER_PAIRS = {
    "token_reputation": r"(?i)Token Rep:\s*([^|]+)",
    "price_usd": r"(?i)Price:\s*([^|]+)",
    "market_cap": r"(?i)Onchain Market Cap:\s*([^|]+)",
    "holders": r"(?i)Holders:\s*([^|]+)",
    "contract_status": r"(?i)Contract:\s*([^|]+)",
    "transactions": r"(?i)Transactions:\s*([^|]+)",
}


def brand_name(byline: Column) -> Column:
    """``Visit the X Store`` and ``Brand: X`` as X."""
    text = strip(byline)
    visit = blank_to_null(strip(F.regexp_extract(text, r"(?i)^visit the\s+(.+?)\s+store$", 1)))
    named = blank_to_null(strip(F.regexp_extract(text, r"(?i)^brand:\s*(.+)$", 1)))
    return F.coalesce(visit, named, text)


def title_category(title: Column) -> Column:
    """Last of the colon-separated parts at the end of a page title."""
    return blank_to_null(strip(F.regexp_extract(strip(title), r":\s*([^:]+?)\s*:\s*([^:]+?)\s*$", 2)))


def scripts(nodes: Column, test=None) -> Column:
    found = F.filter(nodes, lambda n: (n["tag"] == "script") & (F.lit(True) if test is None else test(n)))
    return F.transform(found, lambda n: H.raw_text(nodes, n))


def product_fields(nodes: Column, url: Column) -> Column:
    """Product page fields by selector, with the fallbacks that need no JSON search."""

    def finish(found: Column) -> Column:
        def one(name: str) -> Column:
            return F.try_element_at(F.try_element_at(found, F.lit(name)), F.lit(1))

        unreviewed = F.exists(nodes, lambda n: n["text"].isNotNull() & n["text"].rlike("(?i)no customer reviews yet"))
        sold_out = H.first_match(nodes, "#outOfStock")
        in_sold_out = H.first_match(nodes, "#outOfStock .a-color-price, #outOfStock .a-text-bold")
        first_state = H.first_match(nodes, PRODUCT_FIELDS["availability"]["selector"])
        availability = F.when(
            in_sold_out["pre"] == first_state["pre"], blank_to_null(H.text_of(nodes, sold_out))
        ).otherwise(one("availability"))
        stale = availability.rlike("(?i)unavailable|out of stock|back in stock")
        meta_title = F.coalesce(meta_content(nodes, "name", "title"), page_title(nodes))
        shelf = title_category(meta_title)
        return F.struct(
            one("title").alias("title"), brand_name(one("brand")).alias("brand"), one("brand_url").alias("brand_url"),
            one("price").alias("price"), availability.alias("availability"),
            F.coalesce(one("rating"), F.when(unreviewed, F.lit("No customer reviews yet"))).alias("rating"),
            F.coalesce(one("reviews_count"), F.when(unreviewed, F.lit("0 reviews"))).alias("reviews_count"),
            first_filled(F.try_element_at(found, F.lit("category")), F.when(shelf.isNotNull(), F.array(shelf))).alias("category"),
            F.try_element_at(found, F.lit("bullet_points")).alias("bullet_points"),
            F.array_distinct(F.try_element_at(found, F.lit("images"))).alias("images"),
            one("description").alias("description"),
            F.coalesce(one("fulfillment"), F.when(stale, availability)).alias("fulfillment"),
            one("seller").alias("seller"),
        )

    return let(css_fields(nodes, {"fields": PRODUCT_FIELDS}, url), finish)


def product_variants(nodes: Column) -> Column:
    """Variant swatches as ``array<struct<asin, label>>``."""
    swatches = H.matching(nodes, "#twister li[data-defaultasin], #twister li[data-asin]")
    return F.transform(
        swatches,
        lambda n: F.struct(
            first_text(H.attribute(n, "data-defaultasin"), H.attribute(n, "data-asin")).alias("asin"),
            strip(first_text(H.attribute(n, "title"), H.attribute(H.first_match(nodes, "img[alt]", n), "alt"))).alias("label"),
        ),
    )


def variant_responses(nodes: Column) -> Column:
    """Bodies of the captured variant answers embedded in a page."""
    texts = scripts(nodes, lambda n: H.attribute(n, "data-amazon-twister-responses") == "true")
    bodies = F.transform(
        texts, lambda t: F.transform(F.from_json(t, "array<struct<body:string>>"), lambda r: r["body"])
    )
    return F.filter(F.flatten(F.filter(bodies, lambda b: b.isNotNull())), lambda b: b.isNotNull())


def slot_prices(slots: Column) -> Column:
    """What the markup inside each variant slot shows as its price: HTML in JSON in a script, parsed within the row."""
    nested = H.shred_fragments(F.transform(slots, lambda s: s["markup"]))
    return F.transform(nested, lambda n: blank_to_null(H.text_of(n, H.first_match(n, ".a-offscreen, .a-price"))))


def script_objects(nodes: Column) -> Column:
    """JSON objects handed to ``parseJSON`` in the scripts of a page."""
    return F.flatten(F.transform(scripts(nodes), J.embedded_objects))


def priced_variants(nodes: Column, slots: Column, shown_prices: Column, embedded: Column) -> Column:
    """Variants of a product with the state their answer gives: ``array<struct<asin, label, price, availability>>``.

    The swatches of the page, else the pairs ``embedded`` in its scripts; a variant without an answer has no state.
    ``shown_prices`` and ``embedded`` come from Arrow steps, so they are columns of their own, made before this.
    """

    def joined(variants: Column, states: Column) -> Column:
        return F.transform(variants, lambda v: let(F.try_element_at(states, v["asin"]), lambda s: F.struct(
            v["asin"].alias("asin"), v["label"].alias("label"), s["price"].alias("price"), s["availability"].alias("availability")
        )))

    return let(
        J.variant_states(slots, shown_prices),
        lambda states: joined(first_filled(product_variants(nodes), embedded), states),
    )


def seller_fields(nodes: Column, url: Column) -> Column:
    """Seller page fields and its product cards."""

    def value(card: Column, selector: str, name: str | None) -> Column:
        node = H.first_match(nodes, selector, card)
        if name:
            return U.join(url, blank_to_null(H.attribute(node, name)))
        return blank_to_null(H.text_of(nodes, node))

    cards = F.transform(
        H.matching(nodes, ".seller-product"),
        lambda c: F.struct(
            H.attribute(c, "data-asin").alias("asin"),
            *[value(c, s, a).alias(f) for f, (s, a) in LISTING_FIELDS.items()],
        ),
    )
    fields = css_fields(nodes, {"fields": SELLER_FIELDS}, url)
    return let(
        fields,
        lambda f: F.struct(
            F.try_element_at(f, F.lit("seller_name"))[0].alias("title"),
            *[F.try_element_at(F.try_element_at(f, F.lit(k)), F.lit(1)).alias(k) for k in SELLER_FIELDS],
            cards.alias("product_listings"),
        ),
    )


def explorer_fields(nodes: Column, resource_type: Column) -> Column:
    """Chain-explorer page: heading, product JSON, the ``Key: value`` pairs of the description, code."""
    ld = F.filter(
        scripts(nodes, lambda n: H.attribute(n, "type") == "application/ld+json"),
        lambda t: J.at(t, "$['@type']") == "Product",
    )
    product = F.element_at(F.concat(F.array(F.lit("{}")), ld), -1)
    heading = H.text_of(nodes, H.first_match(nodes, "main h1, #ContentPlaceHolder1_maincontentinner h1"))
    described = F.coalesce(meta_content(nodes, "name", "description"), F.lit(""))
    pairs = {k: blank_to_null(strip(F.regexp_extract(described, p, 1))) for k, p in EXPLORER_PAIRS.items()}
    pairs["price_usd"] = first_text(J.at(product, "$.offers.price"), pairs["price_usd"])
    code = H.first_match(nodes, "#verifiedbytecode2, #editor, pre")
    return F.struct(
        first_text(J.at(product, "$.name"), heading).alias("title"),
        first_text(J.at(product, "$.description"), described).alias("description"),
        *[v.alias(k) for k, v in pairs.items()],
        J.at(product, "$.offers.priceCurrency").alias("price_currency"),
        F.when(resource_type == "contract", blank_to_null(H.text_of(nodes, code, "\n"))).alias("source_code"),
    )


# How many elements up the lines beside a result stand, and its address patterns with their kinds.
SUBTITLE_UP = 4
SEARCH_KINDS = (
    (r"^https://www\.linkedin\.com/company/([^/]+)/?$", "company", "company"),
    (r"^https://www\.linkedin\.com/in/([^/]+)/?$", "person", "profile"),
    (r"^https://www\.linkedin\.com/jobs/view/(\d+)/?$", "job", "job"),
    (r"^https://www\.linkedin\.com/feed/update/([^/]+)/?$", "post", "post"),
)


def ancestor(nodes: Column, node: Column, steps: int) -> Column:
    """The element so many parents up, or the outermost one: one array access for each step."""
    for _ in range(steps):
        node = let(node, lambda n: F.coalesce(F.when(n["parent"] >= 0, F.get(nodes, n["parent"])), n))
    return node


def subtitle(nodes: Column, anchor: Column, title: Column) -> Column:
    """The first line near a link that isn't its title."""

    def first_other(box: Column) -> Column:
        lines = F.flatten(F.transform(H.strings(nodes, box), lambda t: F.transform(F.split(t, r"\R"), strip)))
        return F.try_element_at(F.filter(lines, lambda x: (x != "") & (x != title)), F.lit(1))

    return F.coalesce(let(ancestor(nodes, anchor, SUBTITLE_UP), first_other), F.lit(""))


def search_results(nodes: Column, limit: int | None = None) -> Column:
    """People, companies, jobs and posts a search page lists, with the line beside them: distinct addresses, all unless limited."""

    def row(anchor: Column) -> Column:
        href = strip(H.attribute(anchor, "href"))
        full = F.when(href.startswith("/"), F.concat(F.lit("https://www.linkedin.com"), href)).otherwise(href)
        bare = F.concat(F.rtrim(U.without_query(full), F.lit("/")), F.lit("/"))
        entity, kind, own = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
        for pattern, name, resource in reversed(SEARCH_KINDS):
            found = F.regexp_extract(bare, pattern, 1)
            entity = F.when(found != "", F.lit(name)).otherwise(entity)
            kind = F.when(found != "", F.lit(resource)).otherwise(kind)
            own = F.when(found != "", found).otherwise(own)
        return F.struct(
            bare.alias("canonical_url"), entity.alias("entity_type"), kind.alias("resource_type"), own.alias("identifier"),
            H.text_of(nodes, anchor).alias("title"), anchor["pre"].alias("at"),
        )

    def shown(r: Column) -> Column:
        names = ("canonical_url", "entity_type", "resource_type", "identifier", "title")
        return F.struct(*[r[n].alias(n) for n in names], let(F.get(nodes, r["at"]), lambda a: subtitle(nodes, a, r["title"])).alias("subtitle"))

    links = F.filter(nodes, lambda n: (n["tag"] == "a") & (strip(H.attribute(n, "href")) != ""))
    rows = F.filter(F.transform(links, row), lambda r: r["entity_type"].isNotNull() & (r["title"] != ""))
    found = first_occurrences(rows, lambda r, _: r["canonical_url"])
    return F.transform(found if limit is None else F.slice(found, 1, limit), shown)
