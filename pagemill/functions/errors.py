"""Errors of failed work, from what was thrown, the answer's status, the page and the session: one ordered list of rules.

Every rule says what a failure must look like and what follows from it; the first that holds decides, so precedence is the
order of a table and not nested code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import policy
from pagemill.functions.arrays import let

# Failures by the kind of exception and status, in the order in which they are looked at. A rule with a
# session needs one (its text is the exception's); the others are the fetcher's.
RULES = (
    # exception, least status, greatest status, code, hint, message, retryable
    ("http_status", 429, 429, "RATE_LIMITED", "wait_and_retry", "Rate limit hit", True),
    ("http_status", 401, 401, "AUTH_EXPIRED", "refresh_session", "Auth failed (401)", True),
    ("http_status", 403, 403, "AUTH_EXPIRED", "refresh_session", "Auth failed (403)", True),
    ("http_status", 404, 404, "PAGE_NOT_FOUND", "skip", "Page not found", False),
    ("http_status", 500, 599, "SERVER_ERROR", "retry_later", "Server error ({status})", True),
    ("timeout", None, None, "NETWORK_ERROR", "retry", "Request timed out", True),
    ("connect", None, None, "NETWORK_ERROR", "retry", "Connection failed", True),
    (None, None, None, "UNKNOWN_ERROR", "inspect", "{detail}", False),
)
# What a platform calls a failed fetch.
PLATFORM_CODES = {
    "wikipedia": "WIKIPEDIA_FETCH_FAILED", "amazon": "AMAZON_FETCH_FAILED", "linkedin": "LINKEDIN_FETCH_FAILED",
    "base": "BASE_CHAIN_FETCH_FAILED", "generic": "GENERIC_FETCH_FAILED", "arxiv": "ARXIV_FETCH_FAILED",
}


def _table() -> Column:
    names = ("exception", "low", "high", "error_code", "agent_hint", "message", "retryable")
    kinds = ("string", "int", "int", "string", "string", "string", "boolean")
    return F.array(*[F.struct(*[F.lit(v).cast(k).alias(n) for v, n, k in zip(rule, names, kinds)]) for rule in RULES])


def classify_failure(exception: Column, status: Column, detail: Column) -> Column:
    """Error of a thrown failure (``http_status``, ``timeout``, ``connect`` or anything else), by the first rule that holds."""

    def holds(rule: Column) -> Column:
        thrown = rule["exception"].isNull() | (rule["exception"] == exception)
        return F.coalesce(thrown & (rule["low"].isNull() | status.between(rule["low"], rule["high"])), F.lit(False))

    def error(rule: Column) -> Column:
        shown = F.replace(F.replace(rule["message"], F.lit("{status}"), F.coalesce(status.cast("string"), F.lit(""))), F.lit("{detail}"), F.coalesce(detail, F.lit("")))
        known = F.when((rule["exception"] == "http_status"), status.cast("int"))
        return F.struct(
            rule["error_code"].alias("error_code"), rule["agent_hint"].alias("agent_hint"), shown.alias("message"),
            rule["retryable"].alias("retryable"), known.alias("status_code"),
        )

    return let(F.element_at(F.filter(_table(), holds), 1), error)


def classify(exception: Column, status: Column, detail: Column, html: Column, url: Column) -> Column:
    """Error of an attempt: what was thrown decides, else what is wrong with the page; NULL for a good page."""
    return F.when(exception.isNotNull(), classify_failure(exception, status, detail)).otherwise(policy.classify_content(html, url))


def auth_failure(own_code: Column, own_error: Column, exception: Column, status: Column, has_session: Column, detail: Column) -> Column:
    """Sign-in error of a failed attempt, or NULL: an error the failure already carries (``own_code`` not null) is taken over
    with the failure's text; with a session a refused answer means that the session ran out."""
    refused = F.coalesce(has_session, F.lit(False)) & (exception == "http_status") & status.isin(401, 403)
    carried = own_error.withField("message", F.coalesce(detail, own_error["message"]))
    expired = F.struct(
        F.lit("AUTH_EXPIRED").alias("error_code"), F.lit("refresh_session").alias("agent_hint"), detail.alias("message"),
        F.lit(True).alias("retryable"), status.cast("int").alias("status_code"),
    )
    return F.when(own_code.isNotNull(), carried).when(refused, expired)


def normalised_error(platform: Column, resource_type: Column, operation: Column, error_type: Column, detail: Column) -> Column:
    """Failure of any operation in its platform's terms."""
    table = F.create_map(*[F.lit(x) for kv in PLATFORM_CODES.items() for x in kv])
    return F.struct(
        platform.alias("platform"), resource_type.alias("resource_type"), operation.alias("operation"),
        F.coalesce(F.try_element_at(table, platform), F.lit(PLATFORM_CODES["generic"])).alias("normalized_code"),
        F.lit(True).alias("retryable"), F.coalesce(detail, F.lit("")).alias("message"), error_type.alias("error_type"),
    )
