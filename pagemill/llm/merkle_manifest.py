"""Merkle manifest of a dataset: SHA-256 midstate trees.

Rows are leaves, in ascending order within each language; eight consecutive nodes have one parent, and the subroots of the
languages are the leaves of a last tree. A node's digest enters its parent as 64 hexadecimal characters, which is one block
of SHA-256: a parent keeps the hash state before each child slot, 32 bytes each. To fold a changed leaf, the state before
its slot is resumed with the replacement and the siblings to the right only; what stands to the left is never hashed again.

Subtrees of a span of leaves are built and folded in one task each, vectorised over the leaves. What is above them is a tree
over their tops, built the same way, of which each subtree gets its path: for each level the state before its slot and the
digests of the run. So no task holds more than a span of rows and one path, however large a language is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import bound_batches, stored

ARITY = 8
#: Levels that one task builds at once; under them are 4,096 leaves, a span.
LEVELS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@lru_cache(maxsize=1)
def _constants() -> tuple[list[np.uint32], np.ndarray]:
    """The round constants and the first state: fractions of the cube and square roots of the first primes."""
    primes = [p for p in range(2, 312) if all(p % q for q in range(2, int(p**0.5) + 1))]

    def fraction(p: int, degree: int) -> int:
        wide, low, high = p << 32 * degree, 0, 1 << 40
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if mid**degree <= wide else (low, mid)
        return low & 0xFFFFFFFF

    return [np.uint32(fraction(p, 3)) for p in primes], np.array([fraction(p, 2) for p in primes[:8]], dtype=np.uint32)


def begun(n: int) -> np.ndarray:
    """n fresh hash states, 8 x n."""
    return np.repeat(_constants()[1][:, None], n, axis=1)


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states (8 x n) after one block (16 x n) each."""
    turn = lambda x, k: x >> np.uint32(k) | x << np.uint32(32 - k)
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for i, k in enumerate(_constants()[0]):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + w[i - 7] + (turn(x, 7) ^ turn(x, 18) ^ x >> np.uint32(3)) + (turn(y, 17) ^ turn(y, 19) ^ y >> np.uint32(10)))
        one = h + (turn(e, 6) ^ turn(e, 11) ^ turn(e, 25)) + (g ^ (e & (f ^ g))) + k + w[i]
        two = (turn(a, 2) ^ turn(a, 13) ^ turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


@lru_cache(maxsize=1)
def _hex() -> np.ndarray:
    """Four hexadecimal characters of every 16-bit number, as one big-endian word."""
    nibble = np.frombuffer(b"0123456789abcdef", np.uint8).astype(np.uint32)
    n = np.arange(1 << 16)
    return nibble[n >> 12] << np.uint32(24) | nibble[n >> 8 & 15] << np.uint32(16) | nibble[n >> 4 & 15] << np.uint32(8) | nibble[n & 15]


def as_block(digest: np.ndarray) -> np.ndarray:
    """Digests (8 x n) as hexadecimal text: one block (16 x n) each."""
    out = np.empty((16, digest.shape[1]), dtype=np.uint32)
    out[0::2], out[1::2] = _hex()[digest >> np.uint32(16)], _hex()[digest & np.uint32(0xFFFF)]
    return out


def closed(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of states that took so many whole blocks."""
    end = np.zeros((16, state.shape[1]), dtype=np.uint32)
    bits = np.asarray(blocks, dtype=np.uint64) * np.uint64(512)
    end[0], end[14], end[15] = 0x80000000, bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return compress(state, end)


def to_bytes(state: np.ndarray) -> np.ndarray:
    """8 x n words as n rows of 32 bytes."""
    return np.ascontiguousarray(state.T).astype(">u4").view(np.uint8).reshape(-1, 32)


def from_bytes(rows: bytes) -> np.ndarray:
    return np.frombuffer(rows, ">u4").reshape(-1, 8).T.astype(np.uint32)


class Level:
    """The runs over some nodes: sizes, digests of parents, and the states that each parent keeps."""

    def __init__(self, nodes: np.ndarray):
        n = nodes.shape[1]
        self.nodes = nodes
        self.sizes = np.minimum(ARITY, n - np.arange(0, n, ARITY))
        state = begun(len(self.sizes))
        self.before = np.empty((ARITY, *state.shape), dtype=np.uint32)
        for slot in range(ARITY):
            self.before[slot] = state
            child = nodes[:, slot::ARITY]
            state[:, : child.shape[1]] = compress(state[:, : child.shape[1]], as_block(child))
        self.parents = closed(state, self.sizes)

    def climb(self, at: np.ndarray, own: np.ndarray, proof: np.ndarray, taken: np.ndarray) -> np.ndarray:
        """The parents' digests when node ``at`` is replaced by ``own``, each alone; ``proof`` takes the siblings."""
        run, slot = at // ARITY, at % ARITY
        size = self.sizes[run]
        state = compress(self.before[slot, :, run].T, as_block(own))
        for k in range(ARITY):
            child = np.minimum(run * ARITY + k, self.nodes.shape[1] - 1)
            right = np.flatnonzero((k > slot) & (k < size))
            state[:, right] = compress(state[:, right], as_block(self.nodes[:, child[right]]))
            other = np.flatnonzero((k != slot) & (k < size))
            proof[:, other] = compress(proof[:, other], as_block(self.nodes[:, child[other]]))
            taken[other] += 1
        return closed(state, size)


def grown(nodes: np.ndarray, n: int, height: int) -> tuple[list[Level], np.ndarray]:
    """The levels over the leaves of a span and its top. Where the span is all n of its key it ends at a single node."""
    levels: list[Level] = []
    while (nodes.shape[1] > 1) if n <= ARITY**height else (len(levels) < height):
        levels.append(Level(nodes))
        nodes = levels[-1].parents
    return levels, nodes


def path_of(levels: list[Level], at: int) -> bytes:
    """For each level over leaf ``at``: size of the run, slot, the state before the slot, and the run's digests."""
    out = []
    for level in levels:
        run, slot = divmod(at, ARITY)
        size = int(level.sizes[run])
        digests = level.nodes[:, run * ARITY : run * ARITY + size]
        out.append(bytes([size, slot]) + to_bytes(level.before[slot, :, run : run + 1]).tobytes() + to_bytes(digests).tobytes())
        at = run
    return b"".join(out)


def follow(path: bytes, own: np.ndarray, proof: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """What rows under one path fold to at its end."""
    at, n = 0, own.shape[1]
    spread = lambda x: np.broadcast_to(x, (x.shape[0], n))
    while at < len(path):
        size, slot = path[at], path[at + 1]
        before, digests = from_bytes(path[at + 2 : at + 34]), from_bytes(path[at + 34 : at + 34 + 32 * size])
        at += 34 + 32 * size
        state = compress(spread(before), as_block(own))
        for k in range(size):
            if k > slot:
                state = compress(state, spread(as_block(digests[:, k : k + 1])))
            if k != slot:
                proof[:] = compress(proof, spread(as_block(digests[:, k : k + 1])))
        taken += size - 1
        own = closed(state, np.full(n, size))
    return own


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return from_bytes(b"".join(column.to_pylist()))


def leaf(columns: list[str], replaced: dict[str, Column] | None = None) -> Column:
    """The digest of a row: of each column ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    shown = [(replaced or {}).get(c, F.col(c)).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in shown]), 256)


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows of (key, ...) with pos and n: their place within their key, and the rows of it.

    Rows are range-partitioned, so a key with most of the rows is spread; a place is the sum of a few counts, of which
    there is one for each partition and key that meet.
    """
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    fields = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(fields)], pa.array(np.full(n, part, np.int64)), pa.array(np.arange(at, at + n))], names=[*fields, "part", "seq"]
            )
            at += n

    # Rows that are equal in all of the order may stand in any order; their number spreads them over partitions.
    order = [F.col("key"), *order, F.col("_row")]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    seen = stored(ranged.mapInArrow(run, f"{kind}, part long, seq long"))
    parts = seen.groupBy("key", "part").agg(F.count("*").alias("rows"), F.min("seq").alias("low"))
    along = Window.partitionBy("key").orderBy("part")
    before = F.sum("rows").over(along.rowsBetween(Window.unboundedPreceding, -1))
    placed = parts.select(
        "key", "part", "low", F.coalesce(before, F.lit(0)).alias("ahead"), F.sum("rows").over(Window.partitionBy("key")).alias("n")
    )
    return seen.join(placed, ["key", "part"]).withColumn("pos", F.col("ahead") + F.col("seq") - F.col("low")).drop("part", "seq", "low", "ahead")


def paths(tops: DataFrame, height: int = LEVELS) -> DataFrame:
    """(key, pos, path, top) of nodes (key, pos, n, digest): the way up to the single node of the key, and its digest."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        levels, top = grown(_digests(group["digest"]), group["n"][0].as_py(), height)
        ways = [path_of(levels, i) for i in range(len(group))]
        made = _binary(np.repeat(to_bytes(top), len(group), axis=0))
        return pa.table([group["key"], group["pos"], group["up"], group["n"], pa.array(ways, pa.binary()), made], names=["key", "pos", "up", "n", "path", "top"])

    width = ARITY**height
    spans = tops.select("key", "pos", F.expr(f"pos div {width}").alias("up"), "n", "digest")
    made = stored(spans.groupBy("key", "up").applyInArrow(run, "key string, pos long, up long, n long, path binary, top binary"))
    if made.where(F.col("n") > width).isEmpty():
        return made.select("key", "pos", "path", "top")
    higher = made.where(F.pmod("pos", F.lit(width)) == 0).select(
        "key", F.col("up").alias("pos"), F.ceil(F.col("n") / width).cast("long").alias("n"), F.col("top").alias("digest")
    )
    upper = paths(higher, height).select("key", F.col("pos").alias("up"), F.col("path").alias("rest"), F.col("top").alias("last"))
    return stored(made.join(upper, ["key", "up"]).select("key", "pos", F.concat("path", "rest").alias("path"), F.col("last").alias("top")))


def manifest(rows: DataFrame, columns: list[str], group: str, order: str, changed: Column, height: int = LEVELS) -> DataFrame:
    """One row per row: ``order``, leaf, subroot, root, proof_sha256, folded_root and verified, digests as lower-case hex.

    ``columns`` make the leaf. Rows of a ``group`` (null is one, and the first) ascend by ``order`` (nulls first), rows of
    one ``order`` by their leaf; equal rows are leaves of their own. ``changed`` is the digest of the leaf as it is found
    now: folded_root is recomputed from it along the stored states and siblings, and verified says that it equals root.
    proof_sha256 is the hash of all siblings on the way up. Other columns are ignored; an empty table gives no rows.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    order_kind = rows.schema[order].dataType.simpleString()
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = rows.select(
        key.alias("key"), F.col(order).alias("id"), F.unhex(leaf(columns)).alias("digest"), F.unhex(changed).alias("changed")
    )
    placed = numbered(leaves, [F.col("id").asc_nulls_first(), F.col("digest")]).withColumn("span", F.expr(f"pos div {ARITY**height}"))

    def first(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        nodes, folded = _digests(group["digest"]), _digests(group["changed"])
        levels, top = grown(nodes, group["n"][0].as_py(), height)
        at, proof, taken = np.arange(len(group)), begun(len(group)), np.zeros(len(group), dtype=np.int64)
        for level in levels:
            folded = level.climb(at, folded, proof, taken)
            at = at // ARITY
        return pa.table(
            [*(group[c] for c in ("key", "span", "n", "pos", "id", "digest")), _binary(to_bytes(folded)), _binary(to_bytes(proof)), pa.array(taken), _binary(np.repeat(to_bytes(top), len(group), axis=0))],
            names=["key", "span", "n", "pos", "id", "digest", "folded", "proof", "taken", "top"],
        )

    low = stored(placed.groupBy("key", "span").applyInArrow(
        first, f"key string, span long, n long, pos long, id {order_kind}, digest binary, folded binary, proof binary, taken long, top binary"
    ))
    tops = low.where(F.pmod("pos", F.lit(ARITY**height)) == 0).select(
        "key", F.col("span").alias("pos"), F.ceil(F.col("n") / ARITY**height).cast("long").alias("n"), F.col("top").alias("digest")
    )
    ways = paths(tops, height)
    subroots = ways.where("pos = 0").select(F.lit("").alias("key"), F.col("key").alias("of"), F.col("top").alias("digest"))
    ranked = stored(numbered(subroots, [F.col("of")]))
    last = ranked.join(paths(ranked.select("key", "pos", "n", "digest"), height), ["key", "pos"]).select(F.col("of").alias("key"), F.col("path").alias("rest"), F.col("top").alias("root"))
    ways = ways.join(last, "key").select("key", F.col("pos").alias("span"), F.concat("path", "rest").alias("path"), F.col("top").alias("subroot"), "root")

    def finish(group: pa.Table, way: pa.Table) -> pa.Table:
        if not len(group):
            return pa.table([pa.array([], t) for t in (group.schema.field("id").type, *[pa.binary()] * 5)], names=names)
        proof, taken, n = _digests(group["proof"]), group["taken"].to_numpy().copy(), len(group)
        folded = follow(way["path"][0].as_py(), _digests(group["folded"]), proof, taken)
        same = lambda c: pa.array([way[c][0].as_py()] * n, pa.binary())
        return pa.table([group["id"], group["digest"], same("subroot"), same("root"), _binary(to_bytes(closed(proof, taken))), _binary(to_bytes(folded))], names=names)

    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    found = low.groupBy("key", "span").cogroup(ways.groupBy("key", "span")).applyInArrow(
        finish, f"id {order_kind}, leaf binary, subroot binary, root binary, proof_sha256 binary, folded_root binary"
    )
    shown = [F.lower(F.hex(c)).alias(c) for c in names[1:]]
    return found.select(F.col("id").alias(order), *shown, (F.col("folded_root") == F.col("root")).alias("verified"))


#: The columns of ``documents`` that make a leaf, in this order.
DOCUMENT = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered_every_third() -> Column:
    """The leaf of a document whose text's A-Z were lower-cased where 3 divides crc32 of its doc_id, else its own."""
    hit = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0, F.lit(False))
    return leaf(DOCUMENT, {"text": F.when(hit, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))})
