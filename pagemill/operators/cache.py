"""A content-addressed table of finished results, so that equal requests are answered once.

Rows are keyed by a digest of what was asked and lie in folders by batch and by the digest's first two characters. A run
reads only the folders its own keys fall into (256 at most), and adds its new rows as one batch; writing a batch again
replaces it, so a run that was repeated after a failure leaves no second copy.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.keyed import keep_first

#: What is kept of a result.
FIELDS = "status string, values map<string,string>, confidence double"
ENTRY = f"cache_key string, shard string, batch string, {FIELDS}"


def shard(key: Column) -> Column:
    return F.left(key, F.lit(2))


def read_cache(asked: DataFrame, path: str) -> DataFrame:
    """(cache_key, status, values, confidence) of the kept results that ``asked`` (cache_key) may want, one row per key: of
    a key that two runs kept at the same time the earlier batch counts. A folder that isn't there yet is an empty cache."""
    spark = asked.sparkSession
    names = ["cache_key", *(f.strip().split(" ")[0] for f in FIELDS.split(", "))]
    try:
        kept = spark.read.schema(ENTRY).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY).select(*names)
    # The list of shards is bounded by their number; it prunes folders before the join looks at keys.
    shards = [r[0] for r in asked.select(shard(F.col("cache_key"))).where("cache_key is not null").distinct().collect()]
    near = kept.where(F.col("shard").isin(shards)).join(asked.select("cache_key").distinct(), "cache_key", "left_semi")
    return keep_first(near, ["cache_key"], ["batch"]).select(*names)


def add_to_cache(results: DataFrame, path: str, batch: str) -> None:
    """Keep results (cache_key and FIELDS) under ``batch``: finished ones only, absent keys only, each key once."""
    finished = results.where(~F.col("status").isin("failed", "skipped", "pending_agent") & F.col("cache_key").isNotNull())
    held = read_cache(finished.select("cache_key"), path).select("cache_key")
    fresh = keep_first(finished.join(held, "cache_key", "left_anti"), ["cache_key"], ["confidence", F.to_json("values")])
    rows = fresh.select("cache_key", "status", "values", "confidence", shard(F.col("cache_key")).alias("shard"))
    rows.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/batch={batch}")
