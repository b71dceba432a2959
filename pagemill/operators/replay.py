"""Replays of sequential policies that stay parallel inside one key.

A policy is a fold over the events of a key in time order. One key may hold a third of all
events, so the fold is split: events are range-partitioned by (key, time) into blocks of about
equal size, every block is summarised on its own, the few summaries of a key are chained, and
every block is then finished with what enters it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import specs
from pagemill.session import cut_lineage

BLOCK = "_block"


def ordered_blocks(df: DataFrame, keys: list[str], order: list[str], blocks: int | None = None) -> DataFrame:
    """Number equal-sized ranges of the (key, order) sequence.

    The numbering is fixed by writing it out: range bounds come from sampling and would not be
    the same in a second pass over the same query.
    """
    names = [*keys, *order]
    ranged = df.repartitionByRange(blocks, *names) if blocks else df.repartitionByRange(*names)
    return cut_lineage(ranged.sortWithinPartitions(*names).withColumn(BLOCK, F.spark_partition_id()))


def take_first(df: DataFrame, order: list[str], n: int, small: int = 10_000) -> DataFrame:
    """First ``n`` rows in ``order``, exactly, without gathering them in one task when ``n`` is large."""
    if n <= small:
        return df.orderBy(*order).limit(n)
    base = ordered_blocks(df, [], order)
    # One row per range partition.
    sizes = base.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    skips = sizes.select(BLOCK, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_skip"))
    place = F.row_number().over(Window.partitionBy(BLOCK).orderBy(*order)) + F.col("_skip")
    ranked = base.join(F.broadcast(skips), BLOCK).withColumn("_place", place)
    return ranked.filter(F.col("_place") <= n).drop(BLOCK, "_skip", "_place")


def admit_times(
    df: DataFrame, keys: list[str], at: str, order: list[str], interval: Column, burst: Column | int = 1,
    blocks: int | None = None,
) -> DataFrame:
    """When each request may start under a rate of one per ``interval`` with a burst allowance.

    ``burst = 1`` is minimum spacing, a larger one a token bucket. With requests numbered from 0
    the bucket is next empty at ``(n + 1) * interval + max over j <= n of (at_j - j * interval)``;
    a running maximum replaces the fold. Times and interval are in the same integer unit; the
    interval and burst of a key must not change.
    """
    burst = F.lit(burst) if isinstance(burst, int) else burst
    base = ordered_blocks(df.withColumns({"_interval": interval, "_burst": burst}), keys, [at, *order], blocks)
    local = Window.partitionBy(*keys, BLOCK).orderBy(at, *order)
    numbered = base.withColumn("_n", F.row_number().over(local) - 1)
    slack = F.col(at) - F.col("_n") * F.col("_interval")
    numbered = numbered.withColumn("_slack", F.max(slack).over(local.rowsBetween(Window.unboundedPreceding, 0)))
    totals = numbered.groupBy(*keys, BLOCK).agg(
        F.count(F.lit(1)).alias("_size"), F.max("_slack").alias("_peak"), F.first("_interval").alias("_step")
    )
    before = (
        Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = totals.withColumn("_skip", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    totals = totals.withColumn("_enter", F.max(F.col("_peak") - F.col("_skip") * F.col("_step")).over(before))
    joined = numbered.join(totals.select(*keys, BLOCK, "_skip", "_enter"), [*keys, BLOCK])
    shift = F.col("_skip") * F.col("_interval")
    peak = F.greatest(F.col("_slack") - shift, F.col("_enter"))
    empty_at = (F.col("_skip") + F.col("_n") + 1) * F.col("_interval") + peak
    admitted = F.greatest(F.col(at), empty_at - F.col("_burst") * F.col("_interval"))
    return joined.withColumn("admitted_at", admitted).withColumn("waited", admitted - F.col(at)).drop(
        BLOCK, "_n", "_slack", "_skip", "_enter", "_interval", "_burst"
    )


def budget_gate(df: DataFrame, order: list[str], used: str, budget: int, blocks: int | None = None) -> DataFrame:
    """Which rows still run under a token budget.

    A row is skipped when what was consumed plus the mean of the rows that used tokens exceeds
    the budget. A skipped row consumes nothing, so nothing after it can run either: the admitted
    rows are exactly those before the first row whose prefix breaks the rule.
    """
    base = ordered_blocks(df, [], order, blocks)
    local = Window.partitionBy(BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.when(F.col(used) > 0, F.col(used)).otherwise(F.lit(0)).cast("long")
    counted = F.when(F.col(used) > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
    sums = base.withColumns(
        {"_spent": F.coalesce(F.sum(spent).over(local), F.lit(0)), "_count": F.coalesce(F.sum(counted).over(local), F.lit(0))}
    )
    totals = base.groupBy(BLOCK).agg(F.sum(spent).alias("s"), F.sum(counted).alias("c"))
    # One row per range partition: a bounded number, whatever the size of the data.
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    enter = totals.select(
        BLOCK,
        F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_s0"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_c0"),
    )
    whole = sums.join(F.broadcast(enter), BLOCK).withColumns(
        {"consumed_before": F.col("_spent") + F.col("_s0"), "_samples": F.col("_count") + F.col("_c0")}
    )
    mean = F.greatest(F.lit(1), F.expr("consumed_before div _samples"))
    broken = (F.col("_samples") > 0) & (F.col("consumed_before") + mean > budget)
    row = F.struct(*order)
    first = whole.filter(broken).agg(F.min(row).alias("r")).first()["r"]
    if first is None:
        admitted = F.lit(True)
    else:
        admitted = row < F.struct(*[F.lit(v).alias(n) for n, v in zip(order, first)])
    return whole.withColumn("admitted", admitted).drop(BLOCK, "_spent", "_count", "_s0", "_c0", "_samples")


# --- circuit breaker --------------------------------------------------------------------------

OK, TRIP, OTHER = 0, 1, 2
CLOSED = -1  # a state is CLOSED - failures while closed, else the time until which it is open


def outcome(error_code: Column) -> Column:
    """0 for success, 1 for an error that counts against the platform, 2 for any other error."""
    return (
        F.when(error_code.isNull(), F.lit(OK)).when(error_code.isin(*specs.TRIP_CODES), F.lit(TRIP)).otherwise(F.lit(OTHER))
    )


def _exits(at: np.ndarray, kind: np.ndarray, limit: int, pause: np.ndarray) -> np.ndarray:
    """Leaving state for every (event, failures) that a block can be entered at, from the back."""
    size = len(at)
    exits = np.empty((size + 1, limit), dtype=np.int64)
    exits[size] = CLOSED - np.arange(limit)
    until = at + pause
    landing = np.searchsorted(at, until, side="left")
    for i in range(size - 1, -1, -1):
        if kind[i] == OK:
            exits[i] = exits[i + 1][0]
        elif kind[i] == OTHER:
            exits[i] = exits[i + 1]
        else:
            exits[i, : limit - 1] = exits[i + 1][1:]
            exits[i, limit - 1] = until[i] if landing[i] == size else exits[landing[i]][0]
    return exits


def _segments(batches: Iterator[pd.DataFrame], key: str) -> list[pd.DataFrame]:
    """Rows of one block, cut where the key changes. A block is one bounded, sorted partition."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return []
    rows = pd.concat(parts, ignore_index=True)
    keys = rows[key].to_numpy()
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return [rows.iloc[a:b] for a, b in zip(np.append(0, cuts), np.append(cuts, len(rows)))]


def _transfer(times: np.ndarray, kind: np.ndarray, failures: int, pause: np.ndarray) -> tuple[list, list, list]:
    """How a stretch of events maps the state it is entered with to the one it is left with."""
    table = _exits(times, kind, failures, pause)
    exits = table[:-1, 0]
    # An open circuit that lands on event i leaves like a fresh start there. Neighbours that
    # leave alike share one entry, so the table stays short.
    ends = np.append(np.flatnonzero(np.diff(exits) != 0), len(times) - 1)
    return table[0].tolist(), times[ends].tolist(), exits[ends].tolist()


def _enter(state: int, closed: list, upto: list, exits: list) -> int:
    if state <= CLOSED:
        return int(closed[CLOSED - state])
    place = int(np.searchsorted(np.asarray(upto), state, side="left"))
    return int(exits[place]) if place < len(upto) else state


def _allow(times, kinds, pauses, state: int, failures: int) -> list[bool]:
    """The policy itself, event by event."""
    allowed = []
    for time, what, wait in zip(times.tolist(), kinds.tolist(), pauses.tolist()):
        if state > CLOSED and time < state:
            allowed.append(False)
            continue
        failed = 0 if state > CLOSED else CLOSED - state
        allowed.append(True)
        failed = 0 if what == OK else failed + (what == TRIP)
        state = time + wait if what == TRIP and failed >= failures else CLOSED - failed
    return allowed


def breaker_replay(
    df: DataFrame, key: str, at: str, order: str, kind: str, pause: str,
    failures: int = specs.BREAKER_FAILURES, blocks: int | None = None,
) -> DataFrame:
    """Add ``allowed``: whether the circuit breaker of the key lets each request through.

    ``at`` and ``pause`` (cooldown of an event) are integer times above zero. A success closes the
    circuit, ``failures`` counted errors open it until the event time plus its pause, and the first
    request at or after that time starts afresh.

    Only the first and the last key of a block can run over its edge, so at most two summaries per
    block are chained; every other key begins and ends inside one block.
    """
    base = ordered_blocks(df.select(key, at, order, kind, pause), [key], [at, order], blocks)
    key_field, block_field = base.schema[key], T.StructField(BLOCK, T.IntegerType())
    longs = T.ArrayType(T.LongType())
    summary_schema = T.StructType(
        [key_field, block_field, T.StructField("closed", longs), T.StructField("upto", longs), T.StructField("exits", longs)]
    )

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = _segments(batches, key)
        edges = cut[:1] + cut[-1:] if len(cut) > 1 else cut
        for rows in edges:
            closed, upto, exits = _transfer(
                rows[at].to_numpy(), rows[kind].to_numpy(), failures, rows[pause].to_numpy()
            )
            yield pd.DataFrame(
                {key: rows[key].iloc[:1].tolist(), BLOCK: [int(rows[BLOCK].iloc[0])], "closed": [closed], "upto": [upto], "exits": [exits]}
            )

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(BLOCK)
        state, entries = CLOSED, []
        for closed, upto, exits in zip(rows["closed"], rows["upto"], rows["exits"]):
            entries.append(state)
            state = _enter(state, closed, upto, exits)
        return pd.DataFrame({key: rows[key], BLOCK: rows[BLOCK], "_entry": entries})

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _segments(batches, key):
            allowed = _allow(
                rows[at].to_numpy(), rows[kind].to_numpy(), rows[pause].to_numpy(), int(rows["_entry"].iloc[0]), failures
            )
            yield pd.DataFrame({key: rows[key], order: rows[order], "allowed": allowed})

    entry_schema = T.StructType([key_field, block_field, T.StructField("_entry", T.LongType())])
    entries = base.mapInPandas(summarise, summary_schema).groupBy(key).applyInPandas(chain, entry_schema)
    # Two rows per block at most, so the broadcast is bounded by the number of partitions.
    entered = base.join(F.broadcast(entries), [key, BLOCK], "left").withColumn(
        "_entry", F.coalesce("_entry", F.lit(CLOSED).cast("bigint"))
    )
    out_schema = T.StructType([key_field, base.schema[order], T.StructField("allowed", T.BooleanType())])
    return entered.mapInPandas(finish, out_schema)
