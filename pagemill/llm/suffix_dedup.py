"""Suffix-array dedup: longest-previous-factor arrays over the stretches of text that can repeat.

A string of ``size`` bytes (400) belongs to the anchor in it: the ``ANCHOR``-byte string of least hash, the leftmost
of equal ones. Equal strings have equal anchors, so all that can match meets under one anchor, and strings whose
anchor occurs once in all texts are done with. Consecutive strings with one anchor are shipped as one stretch, and
equal texts as one text. Tasks take the stretches of many anchors at a time and bring their suffixes into order: the
suffixes from the anchors on are sorted, and each byte further left is induced by one stable sort on that byte. In
suffix order the strings that agree on ``size`` bytes stand together as a run. The previous smaller position within a
run is the earlier match of a suffix, so its longest previous factor reaches ``size`` exactly if it has one, and its
longest next factor if it has a next one. A hot anchor's stretches are not gathered: Spark counts its strings by two
64-bit hashes, with partial sums, to the same effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.bpe import rows_of
from pagemill.llm.common import hash_filter, in_filter, merged_runs, stored
from pagemill.llm.textops import buffers, inverse_powers, mix, powers, prefix, span_hashes, steps

SIZE = 400
ANCHOR = 200
#: Bytes of stretches whose suffixes are ordered at once, but for the last anchor's.
CHUNK = 1 << 22
#: An anchor with more stretches than this, about 12 MB of them, is hot.
HOT = 20_000
_SECOND = 0xD6E8FEB86659FD93


def _windows_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive values: running minima of blocks from either side."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _stretches(data: np.ndarray, offsets: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, row, first start (in the data), number of starts and anchor's place after the first start of each
    stretch of the rows of a step."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < size:
        return none.astype(np.uint64), none, none, none, none
    places = np.arange(len(data) - anchor + 1)
    hashes = span_hashes(prefix(data), places, places + anchor)
    # The high bits of the hash, then the place: the least of these is the leftmost place of the least hash.
    bits = np.uint64(max(1, len(places).bit_length()))
    least = _windows_min(hashes >> bits << bits | places.astype(np.uint64), size - anchor + 1)
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(at)), side="right") - 1
    whole = np.flatnonzero(np.arange(len(at)) + size <= offsets[row + 1])
    if not len(whole):
        return none.astype(np.uint64), none, none, none, none
    new = np.concatenate([[True], (at[whole][1:] != at[whole][:-1]) | (row[whole][1:] != row[whole][:-1])])
    first = whole[new]
    return hashes[at[first]], row[first], first, np.diff(np.append(np.flatnonzero(new), len(whole))), at[first] - first


def _pieces(step: pa.RecordBatch, size: int, limit: int = 1 << 23) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Data, offsets, row numbers and base of a step; a single longer row comes in pieces that overlap."""
    data, offsets = buffers(step.column(step.schema.get_field_index("text")))
    if step.num_rows > 1 or len(data) <= limit:
        yield data, offsets, np.arange(step.num_rows), 0
        return
    for base in range(0, max(1, len(data) - size + 1), limit):
        piece = data[base : base + limit + size - 1]
        yield piece, np.array([0, len(piece)]), np.zeros(1, dtype=np.int64), base


def _texts(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    """doc_id, digest (SHA-256 of the text), n_bytes and the anchors of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                raw = rows_of(step.column(1))
                anchors: list[list[np.ndarray]] = [[] for _ in raw]
                for data, offsets, rows, _ in _pieces(step, size):
                    key, row, *_ = _stretches(data, offsets, size, anchor)
                    cut = np.searchsorted(row, np.arange(len(rows) + 1))
                    for i, r in enumerate(rows):
                        anchors[r].append(key[cut[i] : cut[i + 1]])
                sizes = [sum(map(len, a)) for a in anchors]
                flat = np.concatenate([x for a in anchors for x in a] + [np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary()), pa.array([len(t) for t in raw], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat))],
                    names=["doc_id", "digest", "n_bytes", "anchors"],
                )

    read = docs.select(F.col("doc_id").cast("long"), "text")
    return read.mapInArrow(run, "doc_id long, digest binary, n_bytes long, anchors array<long>")


def _shipped(docs: DataFrame, repeated: np.ndarray, hot: np.ndarray, size: int, anchor: int) -> DataFrame:
    """Stretches with a repeated anchor: key, digest, start, n, anchor, bytes. Under a hot anchor a stretch has no bytes, but
    two hashes of each of its strings, as ones and twos."""
    sent = docs.sparkSession.sparkContext.broadcast((repeated, hot))
    names = ["key", "digest", "start", "n", "anchor", "bytes", "ones", "twos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot_bits = sent.value
        seen: set[bytes] = set()
        for batch in batches:
            for step in steps(batch, "text"):
                digests = [hashlib.sha256(t).digest() for t in rows_of(step.column(0))]
                new = np.array([d not in seen and not seen.add(d) for d in digests], dtype=bool)
                for data, offsets, rows, base in _pieces(step, size):
                    key, row, first, n, after = _stretches(data, offsets, size, anchor)
                    signed = key.view(np.int64)
                    take = in_filter(bits, signed) & new[rows[row]]
                    burning = take & in_filter(hot_bits, signed)
                    take = np.flatnonzero(take & ~burning)
                    raw = data.tobytes()
                    local = offsets[row]
                    none = pa.nulls(len(take), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed[take]), pa.array([digests[rows[r]] for r in row[take]], pa.binary()),
                         pa.array(base + first[take] - local[take]), pa.array(n[take].astype(np.int32)), pa.array(after[take].astype(np.int32)),
                         pa.array([raw[a : a + m + size - 1] for a, m in zip(first[take], n[take])], pa.binary()), none, none], names=names)
                    at = np.flatnonzero(burning)
                    if len(at):
                        stops = np.append(0, np.cumsum(n[at]))
                        start = np.repeat(first[at] - stops[:-1], n[at]) + np.arange(stops[-1])
                        one = span_hashes(prefix(data), start, start + size)
                        sums = np.zeros(len(data) + 1, dtype=np.uint64)
                        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_SECOND, len(data)), out=sums[1:])
                        two = mix((sums[start + size] - sums[start]) * powers(pow(_SECOND, -1, 2**64), len(data) + 1)[start])
                        lists = [pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(h.view(np.int64))) for h in (one, two)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(signed[at]), pa.array([digests[rows[r]] for r in row[at]], pa.binary()), pa.array(base + first[at] - local[at]),
                             pa.array(n[at].astype(np.int32)), pa.array(after[at].astype(np.int32)), pa.nulls(len(at), pa.binary()), *lists], names=names)

    kind = "key long, digest binary, start long, n int, anchor int, bytes binary, ones array<long>, twos array<long>"
    return docs.select("text").mapInArrow(run, kind)


def suffix_order(key: np.ndarray, right: list[bytes], text: np.ndarray, at: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(d, order): the stretches that reach ``d`` bytes left of their anchor (at ``at`` in the text), by key, then by
    the suffix that starts there. ``right`` are the bytes from the anchors on, ``reach`` the bytes before them."""
    order = np.array(sorted(range(len(right)), key=lambda i: (key[i], right[i])), dtype=np.int64)
    for d in range(int(reach.max(initial=-1)) + 1):
        order = order[reach[order] >= d]
        if d:
            order = order[np.argsort(key[order] << 8 | text[at[order] - d], kind="stable")]
        yield d, order


def _factors(rows: list[tuple], size: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(digest, first start, last start, earlier) of the maximal rows of starts whose string occurs elsewhere too;
    earlier: 1 if an earlier place has it, else 0. ``rows``: key, least, digest, start, n, anchor, bytes."""
    text = np.frombuffer(b"".join(r[6] for r in rows), dtype=np.uint8)
    base = np.cumsum([0] + [len(r[6]) for r in rows])[:-1]
    n, after = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
    key = np.unique(np.array([r[0] for r in rows]), return_inverse=True)[1]
    by_place = sorted(range(len(rows)), key=lambda i: (rows[i][1], rows[i][2], rows[i][3] + rows[i][5]))
    place = np.empty(len(rows), dtype=np.int64)
    place[by_place] = np.arange(len(rows))
    first = np.cumsum(n) - n
    state = np.zeros(int(n.sum()), dtype=np.int8)
    sums = prefix(text)
    inverse = inverse_powers(sums)
    for d, order in suffix_order(key, [r[6][r[5] :] for r in rows], text, base + after, after):
        some = order[after[order] - n[order] < d]  # those that have a whole string from here
        start = base[some] + after[some] - d
        string = span_hashes(sums, start, start + size, inverse)
        new = np.flatnonzero(np.append(True, (string[1:] != string[:-1]) | (key[some][1:] != key[some][:-1]))[: len(some)])
        length = np.diff(np.append(new, len(some)))
        if len(some) and length.max() > 1:
            # The run's least position has no previous smaller one; every other has.
            least = np.repeat(np.minimum.reduceat(place[some], new), length)
            found = np.where(np.repeat(length, length) > 1, np.where(place[some] > least, 2, 1), 0)
            state[first[some] + after[some] - d] = found
    own = np.repeat(np.arange(len(rows)), n)
    cut = np.flatnonzero(np.append(True, (state[1:] != state[:-1]) | (own[1:] != own[:-1]))[: len(own)])
    for a, b in zip(cut, np.append(cut[1:], len(own))):
        if state[a]:
            _, _, digest, start, *_ = rows[own[a]]
            yield digest, int(start + a - first[own[a]]), int(start + b - 1 - first[own[a]]), int(state[a] == 2)


def _sorted_factors(shipped: DataFrame, size: int) -> DataFrame:
    """(digest, first, last, earlier) from the suffix order of stretches; a chunk takes all of its anchors' stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key, _, digest, start, _, _, raw = row
                if key != last and held + len(raw) > CHUNK:
                    yield _found(_factors(rows, size))
                    rows, held = [], 0
                if rows and key == last and rows[-1][2:4] == (digest, start):
                    continue  # the same text, read by another task
                rows.append(row)
                held, last = held + len(raw), key
        if rows:
            yield _found(_factors(rows, size))

    ordered = shipped.repartition("key").sortWithinPartitions("key", "least", "digest", "start")
    return ordered.select("key", "least", "digest", "start", "n", "anchor", "bytes").mapInArrow(run, "digest binary, first long, last long, earlier int")


def _found(rows: Iterator[tuple[bytes, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["digest", "first", "last", "earlier"])


def repeated_spans(docs: DataFrame, size: int = SIZE, keep: str = "first", anchor: int = ANCHOR) -> DataFrame:
    """One row per document: doc_id, digest (SHA-256 of the text), n_bytes and spans, the byte runs to remove.

    ``keep="first"`` removes each byte that a ``size``-byte string covers which starts at an earlier place too, by
    doc_id, then byte; ``keep="none"`` removes it if the string starts at any other place. Matches stay within a text.
    Null texts are empty. Repeated rows are copies of each other, so with "first" equal rows of one doc_id are all
    kept or cut alike; a null doc_id comes before all others. An empty table gives no rows.
    """
    made = stored(_texts(docs, size, anchor))
    texts = stored(
        made.groupBy("digest", "n_bytes").agg(F.count("*").alias("copies"), F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("least"), F.first("anchors").alias("anchors"))
    )
    counted = texts.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    counted = stored(counted)
    repeated, hot = hash_filter(counted, "anchor"), hash_filter(counted.where(F.col("n") > HOT), "anchor")
    shipped = stored(_shipped(docs, repeated, hot, size, anchor))
    placed = shipped.join(texts.select("digest", "least"), "digest")
    found = _sorted_factors(placed.where("bytes is not null"), size)

    # A text that several tasks have read counts once; stretches, not their strings, are joined with the texts.
    burning = placed.where("bytes is null").dropDuplicates(["digest", "start"])
    strings = burning.select("digest", "least", F.col("start").alias("base"), F.posexplode(F.arrays_zip("ones", "twos")).alias("at", "hashes")).select(
        F.col("hashes.ones").alias("key"), F.col("hashes.twos").alias("second"), "digest", "least", (F.col("base") + F.col("at")).alias("start")
    )
    of = strings.groupBy("key", "second").agg(F.count("*").alias("n"), F.min(F.struct("least", "digest", "start")).alias("least_place")).where("n > 1")
    burnt = strings.join(of, ["key", "second"]).select(
        "digest", F.col("start").alias("first"), F.col("start").alias("last"),
        (F.col("least_place") != F.struct("least", "digest", "start")).cast("int").alias("earlier"),
    )
    found = found.union(burnt)
    if keep == "first":
        found = found.where("earlier = 1")
    spans = found.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("first", (F.col("last") + size).alias("stop")))).alias("spans"))
    merged = stored(spans.select("digest", merged_runs("spans", "bigint").alias("spans")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_bytes").alias("stop")))
    none = F.array().cast("array<struct<first:bigint,stop:bigint>>")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= size)
    if keep == "first":
        copied = copied & (F.coalesce("doc_id", F.lit(-(1 << 63))) > F.col("least"))
    joined = made.select("doc_id", "digest", "n_bytes").join(texts.select("digest", "copies", "least"), "digest").join(merged, "digest", "left")
    return joined.select("doc_id", "digest", "n_bytes", F.when(copied, whole).otherwise(F.coalesce("spans", none)).alias("spans"))


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(digest, kept): the remaining bytes of each distinct text that loses some, but not all, of its bytes."""
    partly = spans.where("size(spans) > 0 and not (spans[0].first = 0 and spans[0].stop = n_bytes)")
    partly = partly.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("spans").alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(hash_filter(partly.where("doc_id is not null"), "doc_id"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            yield batch.filter(pa.array(in_filter(shared.value, ids) | batch.column(0).is_null().to_numpy(zero_copy_only=False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for raw, spans in zip(rows_of(batch.column(1)), batch.column(2).to_pylist()):
                ends = [0, *(x for s in spans for x in (s["first"], s["stop"])), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], names=["digest", "kept"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(chosen, "doc_id long, text string")
    read = read.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    both = read.join(partly.select("digest", "spans"), "digest").dropDuplicates(["digest"])
    return both.select("digest", "text", "spans").mapInArrow(run, "digest binary, kept binary")
