from urllib.parse import quote, urljoin, urlsplit

from pyspark.sql import functions as F

from pagemill.functions import platform_urls as P
from pagemill.functions import url as U

BASES = ["http://a.example/b/c/d?q#f", "https://h.example", "http://h.example/x/"]
HREFS = [
    "g", "./g", "g/", "/g", "//other.example/g", "?y", "g?y", "#s", "", ".", "./", "..", "../", "../g", "../..", "../../g",
    "../../../g", "/./g", "/../g", "g/../h", "http://z.example/p", "https://z.example", "mailto:x@y", "a//b", "x/./y/../z",
]


def test_join_agrees_with_the_standard_library(spark):
    rows = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "b string, h string")
    got = rows.select("b", "h", U.join(F.col("b"), F.col("h")).alias("j")).collect()
    wrong = [(r.b, r.h, r.j, urljoin(r.b, r.h)) for r in got if r.j != urljoin(r.b, r.h)]
    assert wrong == []


def test_parts_and_encoding(spark):
    url = "HTTPS://user@Host.Example:8080/a b/ü?q=1&r=#frag"
    row = spark.createDataFrame([(url,)], "u string").select(
        U.scheme(F.col("u")), U.hostname(F.col("u")), U.path(F.col("u")), U.query(F.col("u")), U.fragment(F.col("u")),
        U.percent_encode(F.lit("a b~*()/ü"), "_()"), U.percent_decode(F.lit("a%20b+c%C3%BC")),
    ).first()
    parts = urlsplit(url)
    assert list(row[:5]) == ["https", parts.hostname, parts.path, parts.query, parts.fragment]
    assert row[5] == quote("a b~*()/ü", safe="_()") and row[6] == "a b+cü"


def test_network_addresses(spark):
    cases = {
        "https://www.linkedin.com/in/J%C3%A9r%C3%B4me/?x=1": ("profile", "https://www.linkedin.com/in/J%C3%A9r%C3%B4me/"),
        "linkedin.com/company/acme": ("company", "https://www.linkedin.com/company/acme/"),
        "https://cn.linkedin.com/jobs/view/42": ("job", "https://www.linkedin.com/jobs/view/42/"),
        "https://www.linkedin.com/feed/update/urn%3Ali%3Aactivity%3A7/": (
            "post", "https://www.linkedin.com/feed/update/urn:li:activity:7/"),
        "ftp://www.linkedin.com/in/x": ("unknown", ""),
        "https://example.com/in/x": ("unknown", ""),
        "": ("unknown", ""),
    }
    rows = spark.createDataFrame([(u,) for u in cases], "u string").select("u", P.normalize_network(F.col("u")).alias("r"))
    assert {r.u: (r.r.entity_type, r.r.canonical_url) for r in rows.collect()} == cases


def test_template_contract_address_keeps_its_type(spark):
    row = spark.createDataFrame([("https://basescan.org/address/0xAb#code",)], "u string").select(
        P.normalize_chain(F.col("u")).alias("r")
    ).first()
    assert row.r.entity_type == "contract" and row.r.canonical_url.endswith("/address/0xAb/#code")


def test_job_numbers_and_nav(spark):
    url = "https://www.linkedin.com/jobs/search/?currentJobId=123&originToLandingJobPostings=5%2C6%2Cx%2C123"
    row = spark.range(1).select(
        P.job_ids_in_search(F.lit(url)).alias("ids"), P.is_network_nav(F.lit("https://www.linkedin.com/feed/?nis=1")).alias("nav"),
        P.is_network_nav(F.lit("https://www.linkedin.com/in/x/")).alias("own"), P.network_bucket(F.lit(url)).alias("b"),
    ).first()
    assert row.ids == ["123", "5", "6"] and row.nav and not row.own and row.b == "jobs_search"
