"""File sinks. Spark's commit protocol makes each write all-or-nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators.summary import dead_letters, run_summary, runtime_metrics


def write_jsonl(df: DataFrame, path: str, append: bool = False, by: list[str] | None = None) -> None:
    """JSON lines, replaced or appended, optionally partitioned."""
    writer = df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(*by) if by else writer).json(path)


def write_document(row: DataFrame, path: str) -> None:
    """A single small row, such as a summary, as one pretty JSON document."""
    pretty = row.limit(1).select(F.to_json(F.struct(*row.columns), {"pretty": "true"}).alias("value"))
    pretty.coalesce(1).write.mode("overwrite").text(path)


def write_run(results: DataFrame, root: str) -> None:
    """Everything a run leaves: records, errors, dead letters, summary, metrics."""
    failed = F.col("status") == "failed"
    errors = results.filter(failed)
    write_jsonl(results.filter(~failed), f"{root}/records.jsonl")
    write_jsonl(errors, f"{root}/errors.jsonl")
    write_jsonl(dead_letters(errors), f"{root}/dlq.jsonl")
    write_document(run_summary(results, failed), f"{root}/summary.json")
    write_document(runtime_metrics(results, failed, F.col("retryable")), f"{root}/runtime_metrics.json")


def write_chunks(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("overwrite").parquet(path)


def write_requests(requests: DataFrame, path: str) -> None:
    """Submission requests, one JSON line each, a folder per dataset."""
    write_jsonl(requests, path, by=["dataset_id"])


def append_done(records: DataFrame, path: str) -> None:
    """Progress: addresses that need no second visit."""
    records.select("canonical_url").write.mode("append").parquet(path)
