"""Run summaries, error splits and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_of(succeeded: Column, failed: Column) -> Column:
    return (
        F.when((succeeded + failed > 0) & (succeeded == 0), F.lit("failed"))
        .when(failed > 0, F.lit("partial_success"))
        .otherwise(F.lit("success"))
    )


def run_summary(results: DataFrame, failed: Column, by: list[str] | None = None) -> DataFrame:
    """Status and counts of a run, over all rows or per group."""
    counts = [
        F.count_if(~failed).alias("records_succeeded"),
        F.count_if(failed).alias("records_failed"),
    ]
    grouped = results.groupBy(*by).agg(*counts) if by else results.agg(*counts)
    good, bad = F.col("records_succeeded"), F.col("records_failed")
    action = F.when(bad > 0, F.lit("inspect errors.jsonl")).otherwise(F.lit("none"))
    return grouped.withColumns(
        {"records_total": good + bad, "status": status_of(good, bad), "next_action": action}
    )


def runtime_metrics(results: DataFrame, failed: Column, retryable: Column) -> DataFrame:
    """Counters of a run for the metrics sink."""
    return results.agg(
        F.count_if(~failed).alias("succeeded"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & retryable).alias("retryable"),
    )


def dead_letters(errors: DataFrame) -> DataFrame:
    """Errors worth another attempt."""
    return errors.filter(F.col("retryable"))


#: Error codes that need a person to sign in.
SIGN_IN_CODES = (
    "AUTH_REQUIRED", "AUTH_EXPIRED", "CAPTCHA", "AUTH_INTERACTIVE_TIMEOUT",
    "AUTH_SESSION_EXPORT_FAILED", "AUTH_AUTO_LOGIN_FAILED",
)


def sign_in_pending(errors: DataFrame) -> DataFrame:
    """Errors that wait for a sign-in, with their instruction and addresses filled in."""
    action = F.when(
        (F.col("error_code") == "CAPTCHA") & F.coalesce(F.col("next_action"), F.lit("")).isin("", "notify_user"),
        F.lit("complete login in auto-browser and retry"),
    ).otherwise(F.col("next_action"))
    address = F.coalesce(
        F.nullif("public_url", F.lit("")), F.nullif("login_url", F.lit("")), F.col("url")
    )
    return errors.filter(F.col("error_code").isin(*SIGN_IN_CODES)).withColumns(
        {"next_action": action, "public_url": address}
    )
