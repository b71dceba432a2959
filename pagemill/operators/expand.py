"""Network entities expanded to the addresses their pages lead to.

Each candidate wants a few pages: its own, a person's activity, a company's tabs, and the job searches those lead to. The
wanted pages are a relation, answered by one equi-join with the fetched pages; the results are merged in the order in which
the pages are wanted and the addresses stand in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions import platform_urls as P
from pagemill.functions import url as U
from pagemill.functions.arrays import let
from pagemill.operators.chunk import explode_once
from pagemill.operators.keyed import keep_first
from pagemill.session import cut_lineage

# Further pages of an entity, the most job searches that are followed, and where job numbers stand.
COMPANY_TABS = ("jobs/", "people/", "posts/")
PROFILE_PAGES = ("recent-activity/comments/",)
SEARCH_PAGES = 5
JOB_NUMBERS = (r"(?i)/jobs/view/(\d{6,})", r"(?i)currentJobId=(\d+)")
JOB_LISTS = r'(?i)originToLandingJobPostings=([^&"\s<>]+)'
NETWORK = "https://www.linkedin.com/"


def job_numbers(html: Column) -> Column:
    """Distinct job numbers anywhere in markup: addresses, queries, comma lists in queries."""
    listed = F.flatten(F.transform(F.regexp_extract_all(html, F.lit(JOB_LISTS), 1), lambda x: F.split(U.percent_decode(x), ",")))
    plain = F.concat(*[F.regexp_extract_all(html, F.lit(p), 1) for p in JOB_NUMBERS])
    return F.array_distinct(F.concat(plain, F.filter(F.transform(listed, F.trim), lambda x: x.rlike(r"^\d+$"))))


def addresses(html: Column, base: Column) -> Column:
    """Network addresses of a page: anchors in order, then what is embedded in markup."""

    def full(hrefs: Column) -> Column:
        usable = F.filter(hrefs, lambda h: ~h.startswith("#") & ~F.lower(h).startswith("javascript:"))
        joined = F.transform(usable, lambda h: F.when(h.startswith("/"), U.join(F.lit(NETWORK), h)).otherwise(h))
        own = F.filter(joined, lambda u: F.lower(u).contains("linkedin.com") & U.has_web_scheme(u))
        return P.network_links(html, F.transform(own, U.without_fragment))

    return let(H.anchor_targets(html), full)


def wanted_pages(entities: DataFrame) -> DataFrame:
    """(candidate, kind, page_order, page_url) of recognised entities (candidate, kind, canonical_url)."""
    base = F.concat(F.rtrim("canonical_url", F.lit("/")), F.lit("/"))
    more = lambda parts: F.array(*[F.concat(base, F.lit(p)) for p in parts])
    urls = F.concat(
        F.array(F.col("canonical_url")),
        F.when(F.col("kind") == "company", more(COMPANY_TABS)).when(F.col("kind") == "profile", more(PROFILE_PAGES)).otherwise(F.array().cast("array<string>")),
    )
    return entities.select("candidate", "kind", F.posexplode(urls).alias("page_order", "page_url"))


def _found(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """Addresses of the wanted pages that were fetched, with their job numbers; no markup leaves this step."""
    bodies = pages.select(F.col("url").alias("page_url"), F.coalesce("html", F.lit("")).alias("html"))
    return wanted.join(bodies, "page_url").select(
        "candidate", "kind", "page_order", addresses(F.col("html"), F.col("page_url")).alias("urls"), job_numbers(F.col("html")).alias("jobs")
    )


def expand_entities(candidates: DataFrame, pages: DataFrame, filter_nav: bool = True) -> tuple[DataFrame, DataFrame]:
    """(urls, summary) of ``candidates`` (url) with ``pages`` (url, html; one row per url).

    urls: candidate, kind, url, bucket and place, each address once per candidate; profile addresses of a person are told
    apart as profiles_self and profiles_others. summary: candidate, kind, pages (fetched), search_pages, job_ids (sorted,
    comma-joined) and error: ``not_expandable`` where the address names no entity, ``page_missing`` where the own page of a
    person, job or post wasn't fetched (a company does with its tabs). Repeated candidates count once; null ones are dropped.
    """
    shaped = candidates.where("url is not null").select(F.col("url").alias("candidate")).distinct()
    shaped = shaped.select("candidate", P.normalize_network(F.col("candidate")).alias("n")).select(
        "candidate", F.col("n.entity_type").alias("kind"), F.col("n.canonical_url").alias("canonical_url"),
        F.lower(F.try_element_at("n.identity", F.lit("vanity"))).alias("vanity"),
    )
    entities = cut_lineage(shaped)
    known = entities.where("kind <> 'unknown'")
    got = cut_lineage(_found(wanted_pages(known), keep_first(pages, ["url"], ["html"])))

    tabs = explode_once(got.where("kind = 'company'").select("candidate", "kind", "page_order", "urls"), "urls", "position", "found")
    searches = tabs.where(F.col("found").contains("/jobs/search")).select("candidate", "kind", "page_order", "position", F.trim(U.without_fragment(F.col("found"))).alias("page_url"))
    searches = keep_first(searches, ["candidate", "page_url"], ["page_order", "position"])
    order = Window.partitionBy("candidate").orderBy("page_order", "position")
    first_searches = searches.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SEARCH_PAGES)
    searched = cut_lineage(_found(first_searches.select("candidate", "kind", (F.col("nth") + len(COMPANY_TABS)).alias("page_order"), "page_url"), keep_first(pages, ["url"], ["html"])))
    every = got.unionByName(searched)

    rows = explode_once(every.select("candidate", "kind", "page_order", "urls"), "urls", "position", "url")
    asked = rows.where((F.col("kind") == "company") & F.col("url").contains("/jobs/search")).select("candidate", F.explode(P.job_ids_in_search(F.col("url"))).alias("job"))
    held = every.where("kind = 'company'").select("candidate", F.explode("jobs").alias("job"))
    jobs = asked.unionByName(held).distinct()
    job_rows = jobs.select("candidate", F.lit("company").alias("kind"), F.lit(1 << 20).alias("page_order"), F.col("job").cast("decimal(38,0)").cast("long").alias("position"), F.concat(F.lit(f"{NETWORK}jobs/view/"), "job", F.lit("/")).alias("url"))
    rows = rows.select("candidate", "kind", "page_order", F.col("position").cast("long").alias("position"), "url").unionByName(job_rows)
    rows = rows.withColumn("url", F.trim(U.without_fragment(F.col("url")))).where("url <> ''")
    if filter_nav:
        rows = rows.where(~P.is_network_nav(F.col("url")))
    rows = keep_first(rows, ["candidate", "url"], ["page_order", "position"]).join(entities.select("candidate", "vanity"), "candidate")
    own = F.lower(F.try_element_at(P.normalize_network(F.col("url"))["identity"], F.lit("vanity")))
    bucket = P.network_bucket(F.col("url"))
    bucket = F.when((F.col("kind") == "profile") & (bucket == "profile"), F.when(own == F.col("vanity"), "profiles_self").otherwise("profiles_others")).otherwise(bucket)
    urls = rows.select("candidate", "kind", "url", bucket.alias("bucket"), F.struct("page_order", "position").alias("place"))

    counted = every.groupBy("candidate").agg(
        F.count("*").alias("pages"), F.count_if(F.col("page_order") > len(COMPANY_TABS)).alias("search_pages"), F.min("page_order").alias("first_page")
    )
    numbers = jobs.groupBy("candidate").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("job").cast("decimal(38,0)").alias("n"), "job"))), lambda j: j["job"]), ",").alias("job_ids"))
    summary = entities.join(counted, "candidate", "left").join(numbers, "candidate", "left")
    missing = F.col("kind").isin("profile", "job", "post") & (F.coalesce("first_page", F.lit(1)) > 0)
    return urls, summary.select(
        "candidate", "kind", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("search_pages", F.lit(0)).alias("search_pages"),
        F.coalesce("job_ids", F.lit("")).alias("job_ids"),
        F.when(F.col("kind") == "unknown", "not_expandable").when(missing, "page_missing").alias("error"),
    )
