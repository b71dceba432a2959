"""Repeated passages, wherever they begin and end: stretches of at least ``size`` words that an earlier place has too.

Words are those of ``paragraph_dedup``; lines play no part. A window of ``size`` words belongs to the anchor in it: the
leftmost of the least-hashed strings of half as many words. Equal windows have equal anchors, so windows whose anchor
occurs once in all texts are done with, and only the others become rows. The least document of each of these is found
with partial sums and joined back, so a hot passage is not gathered, and no two documents are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import hash_filter, in_filter, stored
from pagemill.llm.paragraph_dedup import MIN_RUN, _keyed
from pagemill.llm.suffix_dedup import _windows_min
from pagemill.llm.textops import NOT_SPACE, Words, buffers, mix, powers, steps

#: Bits of the filter of repeated anchors: 16 MB; when it fills up, more windows become rows.
ANCHOR_BITS = 1 << 27
_SEQUENCE = 0xA0761D6478BD642F
_INVERSE = pow(_SEQUENCE, -1, 2**64)


def _windows(step: pa.RecordBatch, size: int) -> tuple[np.ndarray, ...]:
    """Words of each row; and anchor hash, anchor's place, row, first word (in its row) and hash of each window."""
    data, offsets = buffers(step.column(step.schema.get_field_index("text")))
    words = Words(data, offsets, NOT_SPACE, lower=True)
    hashes, half = words.hashes(), (size + 1) // 2
    if len(hashes) < size:
        none = np.zeros(0, dtype=np.int64)
        return words.counts, none.view(np.uint64), none, none, none, none.view(np.uint64)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_SEQUENCE, len(hashes)), out=sums[1:])
    inverse = powers(_INVERSE, len(sums))
    grams = mix((sums[half:] - sums[:-half]) * inverse[: len(sums) - half])
    # The high bits of the hash, then the place: the least of these is the leftmost place of the least hash.
    bits = np.uint64(len(grams).bit_length())
    least = _windows_min(grams >> bits << bits | np.arange(len(grams), dtype=np.uint64), size - half + 1)
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.searchsorted(words.first, np.arange(len(at)), side="right") - 1
    start = np.flatnonzero(np.arange(len(at)) + size <= words.first[row + 1])
    at, row = at[start], row[start]
    made = mix((sums[start + size] - sums[start]) * inverse[start] + np.uint64(size))
    return words.counts, grams[at], at, row, start - words.first[row], made


def _anchors(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_words and the anchors of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                counts, key, at, row, _, _ = _windows(step, size)
                new = np.ones(len(at), dtype=bool)
                new[1:] = at[1:] != at[:-1]
                ends = np.searchsorted(row[new], np.arange(step.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), step.column(1), pa.array(counts, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(key[new].view(np.int64)))],
                    names=["doc_id", "text_hash", "n_words", "anchors"],
                )

    return docs.mapInArrow(run, "doc_id long, text_hash long, n_words int, anchors array<long>")


def _shipped(docs: DataFrame, repeated: np.ndarray, size: int) -> DataFrame:
    """Windows with a repeated anchor: window, doc_id, text_hash, start and whether the text has it further left. Of
    copies that a task meets, one is taken, and another only if its doc_id is smaller."""
    sent = docs.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            for step in steps(batch, "text"):
                ids, texts = step.column(0).to_numpy(), step.column(1).to_numpy()
                new = np.zeros(step.num_rows, dtype=bool)
                for i, (doc, text) in enumerate(zip(ids.tolist(), texts.tolist())):
                    if text not in seen or doc < seen[text]:
                        seen[text], new[i] = doc, True
                _, key, _, row, start, made = _windows(step, size)
                take = np.flatnonzero(new[row] & in_filter(sent.value, key.view(np.int64)))
                row, start, made = row[take], start[take], made[take]
                again = np.ones(len(take), dtype=bool)
                again[np.unique(mix(made + mix(row.astype(np.uint64))), return_index=True)[1]] = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.view(np.int64)), pa.array(ids[row]), pa.array(texts[row]), pa.array(start, pa.int32()), pa.array(again)],
                    names=["window", "doc_id", "text_hash", "start", "again"],
                )

    return docs.mapInArrow(run, "window long, doc_id long, text_hash long, start int, again boolean")


def repeated_passages(docs: DataFrame, size: int = MIN_RUN) -> DataFrame:
    """The stretches of words that a window of ``size`` words covers which stands at an earlier place too, by doc_id,
    text hash and word; one row for each maximal stretch.

    Columns: doc_id, text_hash, first_word (0, 1, ...), n_words, cluster_id (hash of the first window, or of a text that
    is a copy as a whole), first_doc_id (the least document that has it). The first place itself has no row. Null and
    short texts and rows with a null doc_id have no windows; rows that repeat both doc_id and text are one document. An
    empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    docs = _keyed(docs.where("doc_id is not null"))
    made = stored(_anchors(docs, size))
    texts = stored(made.groupBy("text_hash", "n_words").agg(F.min("doc_id").alias("least"), F.first("anchors").alias("anchors")))
    counted = texts.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n"))
    windows = stored(_shipped(docs, hash_filter(counted.where("n > 1"), "anchor", ANCHOR_BITS), size))

    first = windows.groupBy("window").agg(F.min("doc_id").alias("first_doc_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    placed = windows.join(first, "window")
    names = ("doc_id", "text_hash", "start", "window", "first_doc_id")
    marks = placed.where("again or doc_id > first_doc_id").select(*names)
    # Different texts that share a doc_id: the one of the least hash comes first.
    shared = made.groupBy("doc_id").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b")).where("a <> b").select("doc_id")
    if not shared.isEmpty():
        own = placed.where("doc_id = first_doc_id").join(shared, "doc_id", "left_semi")
        own = own.withColumn("a", F.min("text_hash").over(Window.partitionBy("window")))
        marks = marks.union(own.where("text_hash > a").select(*names))

    in_text = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    apart = F.coalesce(F.col("start") > F.lag("start").over(in_text) + size, F.lit(True)).cast("int")
    runs = marks.withColumn("apart", apart).withColumn("run", F.sum("apart").over(in_text)).groupBy("doc_id", "text_hash", "run").agg(
        F.min("start").alias("first_word"), (F.max("start") - F.min("start") + size).alias("n_words"),
        F.min_by("window", "start").alias("cluster_id"), F.min_by("first_doc_id", "start").alias("first_doc_id"),
    )
    names = ("doc_id", "text_hash", "first_word", "n_words", "cluster_id", "first_doc_id")
    of_text = texts.select("text_hash", "least")
    runs = runs.join(of_text, "text_hash").where("doc_id = least").select(*names)
    copies = made.where(F.col("n_words") >= size).select("doc_id", "text_hash", "n_words").distinct().join(of_text, "text_hash")
    copies = copies.where("doc_id > least").withColumns({"first_word": F.lit(0), "cluster_id": F.col("text_hash"), "first_doc_id": F.col("least")})
    return runs.union(copies.select(*names))
