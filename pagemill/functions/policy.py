"""Fetch policy as expressions: routing, error classes, backoff, error rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill import specs

ERROR = "struct<error_code:string,agent_hint:string,message:string,retryable:boolean,status_code:int>"


def _error(code: str, hint: str, message, retryable: bool, status: Column | None = None) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    number = F.lit(None).cast("int") if status is None else status.cast("int")
    return F.struct(
        F.lit(code).alias("error_code"), F.lit(hint).alias("agent_hint"), text.alias("message"),
        F.lit(retryable).alias("retryable"), number.alias("status_code"),
    )


def no_error() -> Column:
    return F.lit(None).cast(ERROR)


def classify_status(status: Column, failure: Column, detail: Column) -> Column:
    """Error of a failed request from its status, or from ``timeout`` / ``connect`` failures."""
    shown = status.cast("string")
    return (
        F.when(status == 429, _error("RATE_LIMITED", "wait_and_retry", "Rate limit hit", True, status))
        .when(
            status.isin(401, 403),
            _error("AUTH_EXPIRED", "refresh_session", F.concat(F.lit("Auth failed ("), shown, F.lit(")")), True, status),
        )
        .when(status == 404, _error("PAGE_NOT_FOUND", "skip", "Page not found", False, status))
        .when(
            status.between(500, 599),
            _error("SERVER_ERROR", "retry_later", F.concat(F.lit("Server error ("), shown, F.lit(")")), True, status),
        )
        .when(failure == "timeout", _error("NETWORK_ERROR", "retry", "Request timed out", True))
        .when(failure == "connect", _error("NETWORK_ERROR", "retry", "Connection failed", True))
        .otherwise(_error("UNKNOWN_ERROR", "inspect", detail, False))
    )


def _any(text: Column, *needles: str) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | text.contains(needle)
    return hit


def is_product_shell(low: Column, url: Column) -> Column:
    """Retail page that came back as an empty shell. The page markers."""
    place = F.lower(url)
    product = place.contains("amazon.") & _any(place, "/dp/", "/gp/product/")
    generic = _any(
        low,
        '<meta property="og:title" content="amazon"',
        "<title>amazon</title>",
        '<meta property="og:description" content="amazon"',
    )
    details = _any(
        low, 'id="producttitle"', 'id="feature-bullets"', 'id="acrcustomerreviewtext"',
        'id="bylineinfo"', 'id="coreprice',
    )
    shell = _any(low, "previewdoh/amazon.png", 'id="page-shell"')
    return product & generic & shell & ~details


def is_variant_page_incomplete(low: Column, url: Column) -> Column:
    """Retail page whose variant table has not been filled. The page markers."""
    place = F.lower(url)
    product = place.contains("amazon.") & _any(place, "/dp/", "/gp/product/")
    details = _any(low, 'id="producttitle"', 'id="feature-bullets"', 'id="bylineinfo"')
    twister = _any(low, 'id="twister"', 'id="twister_feature_div"', "twisterjsinitializer")
    empty = _any(
        low, '"colortoasin":{}', "'colortoasin': {'initial': '{}'}", '"landingasincolor":"initial"'
    )
    full = _any(low, '"dimensiontoasinmap"', '"colortoasin":{"')
    return product & details & twister & empty & ~full


def classify_content(html: Column, url: Column) -> Column:
    """Problem of a page that did come back, or NULL when it is usable."""
    low = F.lower(html)
    return (
        F.when(
            html.isNull() | (F.length(html) < 200),
            _error("CONTENT_EMPTY", "retry_with_browser", "Page body is empty or too short", True),
        )
        .when(
            low.contains("authwall") | _any(url, "/login", "/checkpoint"),
            _error("AUTH_EXPIRED", "refresh_session", "Hit auth wall or login redirect", True),
        )
        .when(
            _any(low, "captcha", "robot check"),
            _error("CAPTCHA", "complete_auto_login", "Captcha or robot check detected", False),
        )
        .when(
            is_product_shell(low, url) | is_variant_page_incomplete(low, url),
            _error(
                "CONTENT_PARTIAL", "retry_with_browser",
                "Amazon product page returned a shell page without product details", True,
            ),
        )
        .otherwise(no_error())
    )


def next_action(hint: Column) -> Column:
    """Instruction for a person; an unlisted hint is shown with spaces."""
    table = F.create_map(*[F.lit(x) for pair in specs.NEXT_ACTIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, hint), F.replace(hint, F.lit("_"), F.lit(" ")))


def error_row(platform: Column, resource_type: Column, stage: str, error: Column, message: Column | None = None) -> Column:
    """Error record as written to the error sink."""
    return F.struct(
        platform.alias("platform"),
        resource_type.alias("resource_type"),
        F.lit(stage).alias("stage"),
        F.lit("failed").alias("status"),
        error["error_code"].alias("error_code"),
        error["retryable"].alias("retryable"),
        next_action(error["agent_hint"]).alias("next_action"),
        (error["message"] if message is None else message).alias("message"),
    )


def sign_in_required(platform: Column, auto_login: Column) -> Column:
    """Error of a page that needs a signed-in browser; retryable when that can be automated."""
    hint = F.when(auto_login, F.lit("complete_auto_login")).otherwise(F.lit("provide_state"))
    return F.struct(
        F.lit("AUTH_REQUIRED").alias("error_code"), hint.alias("agent_hint"),
        F.concat(platform, F.lit(" requires authenticated browser state")).alias("message"),
        auto_login.alias("retryable"), F.lit(None).cast("int").alias("status_code"),
    )


def route(platform: Column, resource_type: Column, needs_sign_in: Column) -> Column:
    """Backends to try, first to last, by the first matching routing rule."""

    def chain(first: str, rest: tuple[str, ...]) -> Column:
        return F.array(*[F.lit(x) for x in (first, *rest)])

    result = chain(*specs.ROUTING_DEFAULT)
    for name, kind, sign_in, first, rest in reversed(specs.ROUTING_RULES):
        test = platform == name
        if kind is not None:
            test = test & resource_type.eqNullSafe(kind)
        if sign_in is not None:
            test = test & (needs_sign_in == F.lit(sign_in))
        result = F.when(test, chain(first, rest)).otherwise(result)
    return result


def escalate(chain: Column, current: Column) -> Column:
    """Backend after ``current``; an unlisted one escalates to the first fallback; NULL at the end."""
    at = F.array_position(chain, current).cast("int")
    return F.when(at == 0, F.try_element_at(chain, F.lit(2))).otherwise(F.try_element_at(chain, at + 1))


def backend_for_retry(chain: Column, retry: Column, override: Column) -> Column:
    """Backend of the n-th attempt: an override, the default, then the fallbacks in turn."""
    fallback = F.element_at(chain, (F.least(retry, F.size(chain) - 1) + 1).cast("int"))
    return F.coalesce(
        F.nullif(override, F.lit("")),
        F.when((retry > 0) & (F.size(chain) > 1), fallback).otherwise(F.element_at(chain, 1)),
    )


def requests_per_minute(platform: Column) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in specs.RATE_LIMITS.items() for x in (k, v[0])])
    return F.coalesce(F.try_element_at(table, platform), F.lit(specs.RATE_DEFAULT[0]))


def max_retries(platform: Column) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in specs.RATE_LIMITS.items() for x in (k, v[1])])
    return F.coalesce(F.try_element_at(table, platform), F.lit(specs.RATE_DEFAULT[1]))


def backoff_seconds(attempt: Column) -> Column:
    """Delay of a zero-based attempt; later attempts repeat the last delay."""
    steps = F.array(*[F.lit(float(x)) for x in specs.BACKOFF_SECONDS])
    index = F.least(F.greatest(attempt, F.lit(0)), F.lit(len(specs.BACKOFF_SECONDS) - 1)) + 1
    return F.element_at(steps, index.cast("int"))


def after_failure(platform: Column, attempt: Column, now: Column) -> Column:
    """Frontier state after a failed attempt: DEAD, or RETRY_WAIT until a later time.

    ``attempt`` was raised when the entry was leased, so the first delay is the second step.
    """
    dead = attempt >= max_retries(platform)
    later = F.timestamp_seconds(F.unix_micros(now) / 1e6 + backoff_seconds(attempt))
    return F.struct(
        F.when(dead, F.lit("dead")).otherwise(F.lit("retry_wait")).alias("status"),
        F.when(~dead, later).alias("not_before"),
    )
