"""Substring dedup: paragraph MinHash banding, exact verification, removal by components.

A paragraph is a line (split at newlines) of at least ``k`` words; words are lower-cased (A-Z). Equal word
sequences are one node. MinHash bands, tuned to reach ``recall`` at the threshold, give candidate nodes; pairs are
verified by the exact Jaccard similarity of their word shingles and joined into components. The first occurrence
of a component (by document and line) stays, later ones go where duplicated paragraphs stand in a run of at least
``min_run`` words: short furniture such as a licence line or a slogan that many documents share on its own is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import hash_filter, in_filter, stored
from pagemill.llm.families import family_components, listed, listed_nodes, sketch
from pagemill.llm.textops import NOT_SPACE, Words, buffers, mix, powers, shingles, steps

SHINGLE = 5
PERCENT = 80
RECALL = 0.99
MIN_RUN = 30
_SEQUENCE = 0xD1B54A32D192ED03
_SEEDS = np.random.default_rng(0xBA4D).integers(1, 2**63, 128, dtype=np.uint64) | np.uint64(1)


def tune_bands(percent: int = PERCENT, recall: float = RECALL, most: int = 40) -> tuple[int, int]:
    """(bands, rows): the most rows a band, for the fewest false candidates, that reach the recall at the
    threshold with at most ``most`` hashes."""
    share = percent / 100
    for rows in range(most, 0, -1):
        bands = most // rows
        if 1 - (1 - share**rows) ** bands >= recall:
            need = next(b for b in range(1, bands + 1) if 1 - (1 - share**rows) ** b >= recall)
            return need, rows
    return most, 1


class _Paragraphs:
    """The paragraphs of a step: its row, line number, number of words, sequence hash and shingle hashes."""

    def __init__(self, step: pa.RecordBatch, k: int):
        data, offsets = buffers(step.column(step.schema.get_field_index("text")))
        starts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
        if not len(data):
            starts = np.zeros(1, np.int64)
        row = np.searchsorted(offsets, starts[:-1], side="right") - 1
        line = np.arange(len(row)) - np.searchsorted(row, row)
        words = Words(data, starts, NOT_SPACE, lower=True)
        hashes = words.hashes()
        keep = words.counts >= k
        first, n = words.first[:-1][keep], words.counts[keep]
        self.row, self.line, self.n = row[keep], line[keep], n
        own = np.repeat(np.arange(len(n)), n)
        flat = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        taken = hashes[first[own] + flat] if len(own) else hashes[:0]
        bounds = np.concatenate([[0], np.cumsum(n)])
        sums = np.zeros(len(taken) + 1, dtype=np.uint64)
        np.cumsum(taken * powers(_SEQUENCE, int(n.max(initial=0)) + 1)[flat], out=sums[1:])
        self.key = mix(sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(np.uint64))
        self.shingles, self.bounds = shingles(taken, bounds, k)

    def bands(self, bands: int, rows: int) -> np.ndarray:
        """One hash for each band and paragraph."""
        out = np.zeros((bands, len(self.n)), dtype=np.uint64)
        for b in range(bands if len(self.n) else 0):
            for r in range(rows):
                low = np.minimum.reduceat(self.shingles * _SEEDS[b * rows + r], self.bounds[:-1])
                out[b] = mix(out[b] * np.uint64(5) + low)
            out[b] = mix(out[b] + np.uint64(b))
        return out


def paragraphs(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, para (0, 1, ... among paragraphs), line (among all lines), n_words, node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                p = _Paragraphs(step, k)
                para = np.arange(len(p.row)) - np.searchsorted(p.row, p.row)
                at = pa.array(p.row)
                yield pa.RecordBatch.from_arrays(
                    [step.column(0).take(at), step.column(1).take(at), pa.array(para, pa.int32()), pa.array(p.line, pa.int32()),
                     pa.array(p.n, pa.int32()), pa.array(p.key.view(np.int64))],
                    names=["doc_id", "text_hash", "para", "line", "n_words", "node"],
                )

    return _keyed(docs).mapInArrow(run, "doc_id long, text_hash long, para int, line int, n_words int, node long")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _banded(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(signature, node, n) of every paragraph, once for each task that meets it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for step in steps(batch, "text"):
                p = _Paragraphs(step, k)
                _, at = np.unique(p.key, return_index=True)
                new = at[~np.isin(p.key[at], seen)]
                seen = np.union1d(seen, p.key[new])
                sizes = _distinct(p)[new]
                made = p.bands(bands, rows)[:, new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.ravel().view(np.int64)), pa.array(np.tile(p.key[new].view(np.int64), bands)),
                     pa.array(np.tile(sizes, bands), pa.int32())],
                    names=["signature", "node", "n"],
                )

    return docs.select("text").mapInArrow(run, "signature long, node long, n int")


def _distinct(p: _Paragraphs) -> np.ndarray:
    """Distinct shingles of every paragraph."""
    own = np.repeat(np.arange(len(p.n)), np.diff(p.bounds))
    order = np.lexsort((p.shingles, own))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (p.shingles[order][1:] != p.shingles[order][:-1]) | (own[order][1:] != own[order][:-1])
    return np.bincount(own[order][fresh], minlength=len(p.n))


def _sets(docs: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """(node, n, sketch, tokens) of the needed nodes, and of the few others that share a bit with one."""
    shared = docs.sparkSession.sparkContext.broadcast(hash_filter(needed, "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                p = _Paragraphs(step, k)
                _, at = np.unique(p.key, return_index=True)
                at = at[in_filter(shared.value, p.key[at].view(np.int64))]
                tokens = [np.unique(p.shingles[p.bounds[i] : p.bounds[i + 1]]) for i in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.key[at].view(np.int64)), pa.array([len(t) for t in tokens], pa.int64()), _lists([sketch(t) for t in tokens]), _lists(tokens)],
                    names=["node", "n", "sketch", "tokens"],
                )

    return docs.select("text").mapInArrow(run, "node long, n long, sketch array<long>, tokens array<long>").dropDuplicates(["node"])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate([*(a.view(np.int64) for a in arrays), np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def paragraph_clusters(
    docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, recall: float = RECALL, min_run: int = MIN_RUN
) -> DataFrame:
    """The duplicated paragraphs that stand in long enough runs, one row each.

    Columns: doc_id, text_hash, line, n_words, cluster_id (a member's hash), first_doc_id,
    removed (false for a cluster's first occurrence). Null and empty texts, lines of fewer than k
    words and rows with a null doc_id have no paragraphs. Rows that repeat both doc_id and text are one document.
    An empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    docs = docs.where("doc_id is not null")
    bands, rows = tune_bands(percent, recall)
    found = stored(paragraphs(docs, k))
    lists = stored(listed(_banded(docs, k, bands, rows)))
    sets = stored(_sets(docs, listed_nodes(lists), k))
    joined = family_components(
        lists, percent, sets.select("node", "n", "sketch"), lambda nodes: sets.select("node", "tokens").join(nodes, "node", "left_semi")
    )

    place = F.struct("doc_id", "text_hash", "line")
    once = found.groupBy("node").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    grouped = once.join(joined, "node", "left").select("node", "first", "last", F.coalesce("component", "node").alias("cluster_id"))
    # Repeated rows of a document are one place, so a cluster needs two different ones.
    whole = grouped.groupBy("cluster_id").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first <> last")
    member = grouped.select("node", "cluster_id").join(whole.drop("last"), "cluster_id")
    marked = found.dropDuplicates(["doc_id", "text_hash", "line"]).join(member, "node")

    in_doc = Window.partitionBy("doc_id", "text_hash").orderBy("para")
    runs = marked.withColumn("run", F.col("para") - F.row_number().over(in_doc))
    of_run = Window.partitionBy("doc_id", "text_hash", "run")
    return runs.withColumn("run_words", F.sum("n_words").over(of_run)).where(F.col("run_words") >= min_run).select(
        "doc_id", "text_hash", "line", "n_words", "cluster_id",
        F.col("first.doc_id").alias("first_doc_id"),
        (F.col("first") != place).alias("removed"),
    )


def drop_repeated_paragraphs(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """The documents without the lines that ``clusters`` removes; all columns and all other rows stay as they are."""
    gone = clusters.where("removed").groupBy(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).agg(
        F.collect_set("line").alias("_gone")
    )
    lines = F.split("text", "\n", -1)
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("_gone", i)), "\n")
    joined = docs.join(
        gone, (F.col("doc_id").cast("long") == F.col("_gone_id")) & (F.xxhash64("text") == F.col("_gone_hash")), "left"
    )
    return joined.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left)).select(docs.columns)
