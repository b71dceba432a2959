"""Shared Spark helpers of the operators: tables, checkpoints, bit filters and connected components."""

from __future__ import annotations

import time
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import cut_lineage

#: Bits of a filter that is sent to every task: a fixed size, whatever the data.
FILTER_BITS = 1 << 25


#: Bytes of an Arrow batch that goes to a Python worker; a longer single row still comes whole.
BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Have batches cut by bytes, so that long texts don't add up in a worker; every operator sets it for its session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            cut_lineage(spark.range(1))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished steps. It does so when the driver's JVM collects what refers to
    them, which a driver with little to do may put off until the files of many steps fill the disk. What a first
    collection finds unused is let go of by a second one."""
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.05)


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends there and survives lost executors."""
    bound_batches(df.sparkSession)
    release_shuffles(df.sparkSession)
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_filter(filter_bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which 64-bit keys may be among those the filter was built on."""
    at = hashed.astype(np.int64) % (len(filter_bits) * 64)
    return (filter_bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def hash_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit map of fixed size in which the low bits of every 64-bit key are set; false positives are possible.

    It is gathered as at most ``bits / 64`` words, so its size doesn't depend on the data.
    """
    at = F.pmod(F.col(column), F.lit(bits))
    words = (
        keys.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bit"))
    ).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words["word"].to_numpy()] = words["bit"].to_numpy().view(np.uint64)
    return out


def merged_runs(runs: str, kind: str) -> Column:
    """Sorted runs (first, stop) of a column joined where they touch or overlap."""
    last = lambda done: F.element_at(done, -1)
    touch = lambda done, s: (F.size(done) > 0) & (s["first"] <= F.try_element_at(done, F.lit(-1))["stop"])
    grown = lambda done, s: F.concat(
        F.slice(done, 1, F.size(done) - 1),
        F.array(F.struct(last(done)["first"].alias("first"), F.greatest(last(done)["stop"], s["stop"]).alias("stop"))),
    )
    none = F.array().cast(f"array<struct<first:{kind},stop:{kind}>>")
    return F.aggregate(runs, none, lambda done, s: F.when(touch(done, s), grown(done, s)).otherwise(F.concat(done, F.array(s))))


def components(edges: DataFrame, a: str = "a", b: str = "b", store=None) -> DataFrame:
    """(node, component): the smallest node that each node of the undirected edges can reach.

    Alternates large-star and small-star steps (each one grouped minimum and one join), which converge in
    O(log n) rounds also for long chains; every round is written to the shared folder. Hot nodes are met by
    partial aggregation and by the skew join of adaptive execution. An empty edge table gives no rows.
    """
    store = store or stored
    now = store(
        edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).where("low <> high").distinct()
    )
    while True:
        both = now.select(F.col("low").alias("u"), F.col("high").alias("v")).union(
            now.select(F.col("high").alias("u"), F.col("low").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: every larger neighbour is tied to the least of the node's neighbourhood.
        large = (
            both.where("v > u").join(least, "u").select(F.col("m").alias("low"), F.col("v").alias("high"))
            .where("low <> high").distinct()
        )
        # Small star: every node and its smaller neighbours are tied to the least of them.
        large = store(large)
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        tied = large.join(least, "high")
        after = store(
            tied.select(F.col("m").alias("low"), "high").union(tied.select(F.col("m"), F.col("low")))
            .where("low <> high").distinct()
        )
        # Done when every edge runs from a component's least node to a node with no other edge.
        again = after.groupBy("high").agg(F.count("*").alias("n")).where("n > 1").select("high")
        roots = after.select(F.col("low").alias("high")).distinct()
        if after.select("high").join(roots, "high", "left_semi").isEmpty() and again.isEmpty():
            break
        now = after
    return after.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        after.select(F.col("low"), F.col("low")).distinct()
    )
