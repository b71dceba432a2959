"""Benchmark decontamination on a distributed positional inverted index.

The training words are stored as postings, sharded by document: a shard holds, sorted by term, the positions of every
term of some documents, delta-coded and compressed, in the shared folder. Test items are cut into windows of words;
blocks of windows of bounded size are sent to every shard. There a window starts from its rarest term: the postings of
its terms, each shifted back by the term's place in the window, are intersected from the shortest list on. With a
tolerance, the same lists give proximity matches. Documents never leave their shard, so nothing is shuffled but hits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import merged_runs, stored
from pagemill.llm.textops import ALNUM, Words, buffers, steps

#: Words of a window.
WINDOW = 10
#: Bytes of text that a shard takes, unless a single document is longer.
SHARD_BYTES = 4 << 20
#: Windows that are sent to the shards at once.
BLOCK_WINDOWS = 50_000

#: Unused positions between two documents of a shard; a window and its tolerance stay below it.
GAP = 64

_INDEX = "doc_ids array<long>, text_hashes array<long>, n_words array<int>, terms binary, ends binary, places binary"
_FOUND = "doc_id long, text_hash long, items array<string>, hits array<struct<first:int,stop:int>>, near array<string>"


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values, dtype=np.uint32).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype=np.uint32)


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index, a row for each shard: its documents, their word counts, sorted terms, list ends, positions.

    Null and empty texts have no words. A document is known by doc_id and a hash of its text, so rows that share a
    doc_id stay apart unless their texts are equal too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text", SHARD_BYTES):
                data, offsets = buffers(step.column(2))
                words = Words(data, offsets, ALNUM, lower=True)
                terms = words.hashes()
                order = np.argsort(terms, kind="stable")
                ordered = terms[order]
                first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(terms)])
                places = order + np.repeat(np.arange(step.num_rows), words.counts)[order] * GAP
                gaps = np.diff(places, prepend=0)
                gaps[first] = places[first]  # a list begins with the position itself
                ids, texts = pa.array([step.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([step.column(1).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, texts, pa.array([words.counts], pa.list_(pa.int32())), pa.array([ordered[first].tobytes()], pa.binary()),
                     pa.array([_pack(np.append(first[1:], len(order)) if len(first) else first)], pa.binary()), pa.array([_pack(gaps)], pa.binary())],
                    names=["doc_ids", "text_hashes", "n_words", "terms", "ends", "places"],
                )

    return stored(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, _INDEX))


class _Shard:
    """A shard's postings."""

    def __init__(self, row: dict):
        self.doc_ids, self.text_hashes = row["doc_ids"], row["text_hashes"]
        counts = np.array(row["n_words"], dtype=np.int64)
        self.first = np.cumsum(counts) - counts + GAP * np.arange(len(counts))
        self.terms = np.frombuffer(row["terms"], dtype=np.uint64)
        self.ends = np.append(0, _unpack(row["ends"])).astype(np.int64)
        self.gaps = _unpack(row["places"])

    def lookup(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list number and length of each term; length 0 if the shard doesn't have it."""
        if not len(self.terms):
            return np.zeros(terms.shape, dtype=np.int64), np.zeros(terms.shape, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return at, np.where(self.terms[at] == terms, np.diff(self.ends)[at], 0)

    def postings(self, number: int) -> np.ndarray:
        return np.cumsum(self.gaps[self.ends[number] : self.ends[number + 1]], dtype=np.int64)

    def rows(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1


def _within(own: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    """Which wanted positions have one of the sorted own positions within ``slop``."""
    at = np.minimum(np.searchsorted(own, wanted - slop), len(own) - 1)
    return np.abs(own[at] - wanted) <= slop


def _matches(shard: _Shard, windows: np.ndarray, sizes: np.ndarray, slop: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(window, starts of exact matches, places of its rarest word near proximity matches) of windows with a match.

    A proximity match is a start from which every word of the window is within ``slop`` of its place.
    """
    numbers, lengths = shard.lookup(windows)
    inside = np.arange(windows.shape[1]) < sizes[:, None]
    lists: dict[int, np.ndarray] = {}
    for w in np.flatnonzero(((lengths > 0) | ~inside).all(1)):
        rarest, *others = np.argsort(lengths[w, : sizes[w]], kind="stable")
        for i in (rarest, *others):
            if numbers[w, i] not in lists:
                lists[numbers[w, i]] = shard.postings(numbers[w, i])
        places = lists[numbers[w, rarest]]
        starts = (places[:, None] - rarest + np.arange(-slop, slop + 1)).ravel()
        places = np.repeat(places, 2 * slop + 1)
        for i in others:
            near = _within(lists[numbers[w, i]], starts + i, slop)
            starts, places = starts[near], places[near]
            if not len(starts):
                break
        exact = starts[starts + rarest == places] if slop else starts
        for i in others if slop and len(starts) else ():
            exact = exact[_within(lists[numbers[w, i]], exact + i, 0)]
        if len(starts):
            yield int(w), exact, places


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, terms): the windows of ``size`` consecutive words of every item; an item of fewer words, but not
    none, is one window. Items with a null item_id are left out; equal windows of an item are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                data, offsets = buffers(step.column(1))
                words = Words(data, offsets, ALNUM, lower=True)
                terms = words.hashes().view(np.int64)
                items, taken = [], []
                for item, low, high in zip(step.column(0).to_pylist(), words.first[:-1], words.first[1:]):
                    for start in range(low, max(high - size + 1, min(low + 1, high))):
                        items.append(item)
                        taken.append(terms[start : min(start + size, high)])
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(taken, pa.list_(pa.int64()))], names=["item_id", "terms"])

    read = benchmark.where("item_id is not null").select(F.col("item_id").cast("string"), "text")
    return read.mapInArrow(run, "item_id string, terms array<long>").distinct()


def _blocks(windows: DataFrame, size: int) -> Iterator[list]:
    """The windows in blocks of about ``size`` rows, each read from storage in its turn."""
    kept = stored(windows)
    parts = max(1, -(-kept.count() // size))
    for part in range(parts):
        yield kept.where(F.pmod(F.xxhash64("terms", "item_id"), F.lit(parts)) == part).collect()


def search(index: DataFrame, windows: DataFrame, slop: int = 0, block: int = BLOCK_WINDOWS) -> DataFrame:
    """For each document with a match: doc_id, text_hash, the items with an exact match, the word positions (disjoint
    sorted runs of first and stop) that exact matches cover, and the items with a proximity match: a place from which
    each word of a window is within ``slop`` words of where it should be. An empty side gives no rows."""
    out = None
    for rows in _blocks(windows, block):
        sizes = np.array([len(r.terms) for r in rows], dtype=np.int64)
        if sizes.max(initial=0) + slop >= GAP:
            raise ValueError(f"a window and its tolerance must stay below {GAP} words")
        terms = np.zeros((len(rows), int(sizes.max(initial=1))), dtype=np.int64)
        for i, r in enumerate(rows):
            terms[i, : sizes[i]] = r.terms
        sent = index.sparkSession.sparkContext.broadcast((terms.view(np.uint64), sizes, [r.item_id for r in rows]))
        found = index.mapInArrow(_searcher(sent, slop), _FOUND)
        out = found if out is None else out.union(found)
    return out.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    ).withColumn("hits", merged_runs("hits", "int"))


def _searcher(sent, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, sizes, items = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                shard, found = _Shard(row), {}
                for w, starts, anchors in _matches(shard, terms, sizes, slop):
                    for r in np.unique(shard.rows(anchors)):
                        found.setdefault(r, (set(), [], set()))[2].add(items[w])
                    for r, start in zip(shard.rows(starts), starts):
                        found[r][0].add(items[w])
                        found[r][1].append((int(start - shard.first[r]), int(start - shard.first[r] + sizes[w])))
                yield pa.RecordBatch.from_pylist(
                    [{"doc_id": shard.doc_ids[r], "text_hash": shard.text_hashes[r], "items": sorted(i), "hits": _union(h), "near": sorted(n)}
                     for r, (i, h, n) in found.items()], schema=_FOUND_ARROW)

    return run


_FOUND_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("items", pa.list_(pa.string())),
    ("hits", pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))), ("near", pa.list_(pa.string())),
])


def _union(runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for first, stop in sorted(runs):
        if out and first <= out[-1]["stop"]:
            out[-1]["stop"] = max(stop, out[-1]["stop"])
        else:
            out.append({"first": first, "stop": stop})
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = 2) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, items, near.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, lower-cased (A-Z). A document with a
    null or empty text has no words and no match; repeated rows keep a row each; a null doc_id is a value like any
    other. An empty benchmark contaminates nothing. Columns other than doc_id, item_id and text are ignored.
    """
    index = build_index(docs)
    found = search(index, item_windows(benchmark, size), slop)
    found = found.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "items", "near",
        F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["stop"] - h["first"]).alias("n_hit"),
    )
    every = index.select(F.explode(F.arrays_zip("doc_ids", "text_hashes", "n_words")).alias("d")).select(
        F.col("d.doc_ids").alias("doc_id"), F.col("d.text_hashes").alias("text_hash"), F.col("d.n_words").cast("long").alias("n_words")
    )
    none = F.array().cast("array<string>")
    return every.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left").select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("near", none).alias("near"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without an exact occurrence of a window; rows and columns are otherwise kept as they are."""
    found = search(build_index(docs), item_windows(benchmark, size)).where(F.size("items") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(found, same, "left_anti")
