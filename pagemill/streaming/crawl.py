"""Crawl a growing folder of fetched pages, micro-batch by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill.plans.crawl import crawl_records, split
from pagemill.sinks.files import write_jsonl


def page_stream(spark: SparkSession, path: str, schema: str = "page_id long, url string, html string") -> DataFrame:
    """New parquet files of fetched pages."""
    return spark.readStream.schema(schema).parquet(path)


def _done_before(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """Addresses that batches before ``number`` completed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    done = spark.read.schema("canonical_url string, batch long").option("basePath", path).parquet(path)
    return done.where(F.col("batch") < number).select("canonical_url")


def crawl_stream(pages: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Records and errors of new pages, a folder for each batch under ``root``.

    The addresses each batch completed are kept with its number. A batch that runs again, because it ended before its
    commit, sees what the batches before it completed, makes the same rows and overwrites its own folders. The stream
    checkpoint belongs in a folder every executor can reach.
    """

    def batch(rows: DataFrame, number: int) -> None:
        results = crawl_records(rows, _done_before(rows.sparkSession, f"{root}/done", number)).persist()
        records, errors = split(results)
        write_jsonl(records.drop("nodes"), f"{root}/records/batch={number}")
        write_jsonl(errors, f"{root}/errors/batch={number}")
        records.select("canonical_url").write.mode("overwrite").parquet(f"{root}/done/batch={number}")
        results.unpersist()

    writer = pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.trigger(processingTime="60 seconds").start()
