"""N-gram Jaccard join by token-combination prefixes.

A document's set is its distinct word shingles. The tokens (shingle hashes) have one global order: rare ones
before frequent ones, by hash within each class. A pair above the threshold lacks at most ``slack`` of each
other's tokens, so a prefix in that order needs ``slack + 1`` tokens. It is indexed by

* single tokens for the rare class;
* for the frequent class, two-token combinations within a subclass. A subclass with p tokens in the prefix
  guarantees a combination only beyond its first token, so the prefix is extended until
  ``rare + sum(max(0, p - 1)) > slack``. The number of subclasses follows the set size (about one for each 24
  tokens), which keeps combinations in proportion to the prefix; a document is indexed for every size level in
  which a partner may lie.

Which tokens count as frequent is known from the distinct sets that hold them, so copies of a document don't make its
tokens frequent; it is held in a bit map of fixed size. A false positive only means that a rare token is indexed by
combinations, so no link is lost however full the map is.

Documents with equal sets are one node, indexed by the first of them. Nodes that share a signature are paired along the signature's list,
ordered by set size: with the first and with the one before. Verified pairs are joined into components, and only
lists that still hold different components are paired in full, between those components. A family of copies
therefore costs a number of pairs in proportion to its size, and no link between different components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import hash_filter, in_filter, stored
from pagemill.llm.families import family_components, listed, sketch
from pagemill.llm.textops import NOT_SPACE, Words, buffers, mix, shingles, steps

#: A token in the heads of more distinct sets than this belongs to the frequent class.
FREQUENT_AFTER = 1
#: Share of a set, lowest hashes first, in which frequent tokens are counted.
HEAD = 0.2
#: Tokens of a set for each subclass of the frequent class.
PER_SUBCLASS = 24


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of every row."""
    base = 0
    for step in steps(batch, "text"):
        data, offsets = buffers(step.column(step.schema.get_field_index("text")))
        words = Words(data, offsets, NOT_SPACE, lower=True)
        hashes, bounds = shingles(words.hashes(), words.first, k)
        for row in range(step.num_rows):
            yield base + row, np.unique(hashes[bounds[row] : bounds[row + 1]])
        base += step.num_rows


def _node(tokens: np.ndarray) -> bytes:
    return hashlib.md5(tokens.tobytes()).digest()


def _short(node: bytes) -> int:
    """The candidate stage's name of a node."""
    return int.from_bytes(node[:8], "little", signed=True)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def slack(n, percent: int):
    """How many tokens of a set of n a partner may lack."""
    return n - -(-percent * n // 100)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Distinct index signatures of a sorted token set; ``frequent`` marks the frequent class."""
    n = len(tokens)
    if n < 2:  # a partner of a set of one has the same token, and is the same node
        return tokens[:0]
    need = slack(n, percent) + 1
    rare = tokens[~frequent]
    if len(rare) >= need:
        return mix(rare[:need])
    out = [mix(rare)]
    common = tokens[frequent]
    low, high = -(-percent * n // 100), 100 * n // percent
    for level in range(low.bit_length(), high.bit_length() + 1):
        parts = max(1, (1 << (level - 1)) // PER_SUBCLASS)
        sub = (common >> np.uint64(8)) % np.uint64(parts)
        by_sub = np.argsort(sub, kind="stable")
        ordered = sub[by_sub]
        rank = np.empty(len(common), dtype=np.int64)
        rank[by_sub] = np.arange(len(common)) - np.searchsorted(ordered, ordered)
        stop = int(np.searchsorted(np.cumsum(rank > 0), need - len(rare))) + 1
        prefix, sub, rank = common[:stop], sub[:stop], rank[:stop]
        tag = np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)
        by_sub = np.argsort(sub, kind="stable")
        prefix, rank = prefix[by_sub], rank[by_sub]
        for gap in range(1, int(rank.max(initial=0)) + 1):
            later = np.flatnonzero(rank >= gap)
            out.append(mix(mix(prefix[later - gap] + tag) * np.uint64(3) + prefix[later]))
    return np.unique(np.concatenate(out))


def shingle_sets(docs: DataFrame, k: int, head: float = HEAD) -> DataFrame:
    """doc_id, n_shingles, node (128-bit digest of the set; null if empty), the sketch and the head of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, nodes, sketches, heads = batch.column(0), [], [], [], []
            for _, tokens in _sets(batch, k):
                sizes.append(len(tokens))
                nodes.append(_node(tokens) if len(tokens) else None)
                sketches.append(sketch(tokens))
                heads.append(tokens[: int(len(tokens) * head) + 4 if len(tokens) > 1 else 0])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array([x and _short(x) for x in nodes], pa.int64()),
                 _lists(sketches), _lists(heads)],
                names=["doc_id", "n_shingles", "node", "short", "sketch", "head"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, node binary, short long, sketch array<long>, head array<long>"
    )


def _frequent(made: DataFrame) -> np.ndarray:
    """Filter of the tokens of the frequent class. The sets of a token are told apart by 64 places; two that share one
    leave it in the rare class, which costs work and no link."""
    place = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("short", F.lit(64)).cast("int"))
    held = made.select(F.explode("head").alias("token"), place.alias("place")).groupBy("token").agg(F.bit_or("place").alias("sets"))
    return hash_filter(held.where(F.bit_count("sets") > FREQUENT_AFTER), "token")


def _indexed(docs: DataFrame, k: int, percent: int, bits: np.ndarray, firsts: np.ndarray) -> DataFrame:
    """(signature, node, n) of every node, by its first document: one in ``firsts``."""
    shared = docs.sparkSession.sparkContext.broadcast((bits, firsts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        bits, firsts = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(firsts, batch.column(0).to_numpy(zero_copy_only=False))))
            keys, nodes, sizes = [], [], []
            for _, tokens in _sets(batch, k):
                node = _node(tokens)
                if len(tokens) < 2 or node in seen:
                    continue
                seen.add(node)
                made = signatures(tokens, in_filter(bits, tokens), percent)
                keys.append(made)
                nodes.append(np.full(len(made), _short(node)))
                sizes.append(np.full(len(made), len(tokens), dtype=np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes))],
                    names=["signature", "node", "n"],
                )

    read = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    return read.mapInArrow(run, "signature long, node long, n int")


def _tokens_of(docs: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """(node, tokens) of the nodes whose first document is in ``needed`` (doc_id, short)."""
    shared = docs.sparkSession.sparkContext.broadcast(hash_filter(needed, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(in_filter(shared.value, ids)))
            if batch.num_rows:
                made = [tokens for _, tokens in _sets(batch, k)]
                shorts = pa.array([_short(_node(tokens)) for tokens in made], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), shorts, _lists(made)], names=["doc_id", "short", "tokens"])

    read = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    made = read.mapInArrow(run, "doc_id long, short long, tokens array<long>")
    return made.join(needed, ["doc_id", "short"], "left_semi").select(F.col("short").alias("node"), "tokens").dropDuplicates(["node"])


def jaccard_join(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id.

    ``component_id`` is the smallest doc_id reachable over links (Jaccard similarity of at least ``percent``
    hundredths), itself included. A null or empty text, or one without a word, has an empty set and links with
    nothing; one of fewer than k words has its whole word sequence as its only shingle. Repeated rows keep a row
    each; a row with a null doc_id links with nothing and has a null component. Columns other than ``doc_id`` and
    ``text`` are ignored. An empty table gives an empty result.
    """
    made = stored(shingle_sets(docs, k))
    # The candidate stage names a set by 64 bits; each 128-bit digest stands for itself from here on.
    first_of = stored(
        made.where("node is not null and doc_id is not null").groupBy("node", "short")
        .agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    )

    bits, firsts = _frequent(made), hash_filter(first_of, "least")
    lists = stored(listed(_indexed(docs, k, percent, bits, firsts)))

    def sets_of(nodes: DataFrame) -> DataFrame:
        needed = first_of.join(nodes.withColumnRenamed("node", "short"), "short", "left_semi")
        return _tokens_of(docs, needed.select(F.col("least").alias("doc_id"), "short"), k)

    joined = family_components(lists, percent, first_of.select(F.col("short").alias("node"), "n", "sketch"), sets_of)

    part = first_of.join(joined.withColumnRenamed("node", "short"), "short", "left").select(
        "node", "least", F.coalesce("component", "short").alias("part")
    )
    root = part.groupBy("part").agg(F.min("least").alias("component_id"))
    labelled = part.join(root, "part").select("node", "component_id")
    return made.join(labelled, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id; every column stays as it is."""
    gone = joined.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
