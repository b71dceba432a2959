"""Keep-first, upsert, insert-if-absent, queue pop: the keyed-table operators.

``row_number() = 1`` and ``<= n`` become a window group limit that already thins every map
partition before the shuffle, so a key that holds a third of all rows does not reach one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


RANK = "_rank"


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key in ``order``; rows whose keys are all NULL are kept.

    The plain column names in ``order`` must identify a row, so NULL-keyed rows stay apart.
    """
    missing = F.lit(True)
    for key in keys:
        missing = missing & F.col(key).isNull()
    own = F.when(missing, F.to_json(F.struct(*[o for o in order if isinstance(o, str)])))
    window = Window.partitionBy(*keys, own).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def first_n(df: DataFrame, n: int, order: list, by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows, over all or per group: priority dequeue, backlog pop, result limits."""
    if not by:
        return df.orderBy(*order).limit(n)
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) <= n).drop(RANK)


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Union by key where a changed row replaces the current one."""
    newest = changes.select(*keys).distinct()
    return current.join(newest, keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def insert_if_absent(current: DataFrame, additions: DataFrame, keys: list[str]) -> DataFrame:
    """Union by key where a current row stays."""
    fresh = additions.join(current.select(*keys).distinct(), keys, "left_anti")
    return current.unionByName(fresh, allowMissingColumns=True)


def without_keys(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Resume filter: rows whose key has not been completed."""
    return df.join((done.select(*keys).distinct()), keys, "left_anti")


def merge_queues(queues: list[DataFrame], key: str, limit: int | None = None) -> DataFrame:
    """Union of work queues; for one item the last queue wins, in its first position.

    Every queue needs a ``position`` column.
    """
    ranked = None
    for number, queue in enumerate(queues):
        part = queue.withColumn("_queue", F.lit(number))
        ranked = part if ranked is None else ranked.unionByName(part, allowMissingColumns=True)
    others = [c for c in ranked.columns if c not in (key, "_queue", "position")]
    place = F.struct("_queue", "position")
    merged = ranked.groupBy(key).agg(
        F.max_by(F.struct(*others), place).alias("_row"), F.min(place).alias("_place")
    )
    if limit is not None:
        merged = merged.orderBy("_place").limit(limit)
    return merged.select(key, "_row.*", F.col("_place.position").alias("position"))


def due(df: DataFrame, now: Column, available: str = "available_at") -> DataFrame:
    """Delayed rows whose time has come."""
    return df.filter(F.col(available) <= now)
