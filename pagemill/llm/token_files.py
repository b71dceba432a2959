"""Token-ID output: static range asymmetric numeral system (rANS) files.

One frequency table, counted over all tokens, is shared by all files. A file holds a range of documents in ascending
doc_id order, as independent blocks of whole documents. The tokens of a block are dealt to LANES interleaved coders,
token i to lane i mod LANES. A block starts with its document ids and lengths and with each lane's state and number
of words (the checkpoints from which lanes are decoded side by side) and ends with a CRC-32; the file's footer lists
the blocks, so that blocks can be read and decoded in parallel. Coding is vectorised over the lanes of many blocks.

    file   = magic, blocks, footer, footer offset (u64), magic
    block  = n_docs, n_tokens, n_null (u32), ids (i64), lengths (u32), states (u64 x LANES), word counts (u32 x LANES),
             words (u32, lane after lane), CRC-32 of all before (u32)
    footer = for each block: offset (u64), bytes (u64), n_tokens (u64)

All numbers are little-endian. The first n_null documents of a block have no doc_id; 0 is written for it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.bpe import rows_of, tokenizer, worker_encoder
from pagemill.llm.common import shared_folder, stored
from pagemill.llm.textops import steps

MAGIC = b"PMRANS01"
LANES = 32
SCALE = 20
LEAST = np.uint64(1 << 31)
BLOCK_TOKENS = 1 << 16
#: Blocks that are coded at once.
GROUP = 64
#: Tokens of a file, about.
FILE_TOKENS = 8_000_000


class Table:
    """Frequencies of a vocabulary, scaled to 2 ** SCALE; every token that occurs gets at least one slot."""

    def __init__(self, counts: np.ndarray):
        total = max(1, int(counts.sum()))
        freq = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * (1 << SCALE) / total).astype(np.int64), 0)
        # What rounding leaves over goes to the commonest; what it took too much comes off them, one slot each in turn.
        order = np.argsort(-freq, kind="stable")
        over = (1 << SCALE) - int(freq.sum())
        if over > 0:
            freq[order[0]] += over
        while over < 0:
            rich = order[freq[order] > 1][:-over]
            freq[rich] -= 1
            over += len(rich)
        self.freq = freq.astype(np.uint64)
        self.base = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq)), freq).astype(np.uint32)


def _lane_lengths(counts: np.ndarray) -> np.ndarray:
    """Tokens of each lane, blocks x LANES."""
    return (counts[:, None] + LANES - 1 - np.arange(LANES)) // LANES


def encode_blocks(table: Table, blocks: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Final states (blocks x LANES) and the words of every lane, in the order in which a decoder takes them."""
    lengths = _lane_lengths(np.array([len(b) for b in blocks])).ravel()
    deepest = int(lengths.max(initial=0))
    tokens = np.zeros((len(blocks), deepest, LANES), dtype=np.int64)
    for i, b in enumerate(blocks):
        tokens[i].ravel()[: len(b)] = b
    order = np.argsort(-lengths, kind="stable")  # the lanes still at work are always the first ones
    tokens = np.ascontiguousarray(tokens.transpose(1, 0, 2).reshape(deepest, -1)[:, order])
    busy = np.searchsorted(-lengths[order], -np.arange(deepest), side="left")
    state = np.full(len(lengths), LEAST)
    words = np.zeros((len(lengths), deepest), dtype=np.uint32)
    used = np.zeros(len(lengths), dtype=np.int64)
    for t in range(deepest - 1, -1, -1):
        k = busy[t]
        x, f, c = state[:k], table.freq[tokens[t, :k]], table.base[tokens[t, :k]]
        full = np.flatnonzero(x >= f << np.uint64(63 - SCALE))
        words[full, used[full]] = x[full].astype(np.uint32)
        used[full] += 1
        x[full] >>= np.uint64(32)
        whole, rest = np.divmod(x, f)
        state[:k] = (whole << np.uint64(SCALE)) + rest + c
    states, lanes = np.empty_like(state), [None] * len(lengths)
    states[order] = state
    for at, lane in enumerate(order):
        lanes[lane] = words[at, : used[at]][::-1]
    return states.reshape(-1, LANES), lanes


def decode_blocks(table: Table, counts: np.ndarray, states: np.ndarray, lanes: list[np.ndarray]) -> list[np.ndarray]:
    """The tokens of each block."""
    lengths = _lane_lengths(counts).ravel()
    deepest = int(lengths.max(initial=0))
    order = np.argsort(-lengths, kind="stable")
    busy = np.searchsorted(-lengths[order], -np.arange(deepest), side="left")
    state = states.ravel()[order]
    words = np.concatenate([*(lanes[i] for i in order), np.zeros(1, np.uint32)]).astype(np.uint64)
    sizes = np.array([len(lanes[i]) for i in order], dtype=np.int64)
    at = np.cumsum(sizes) - sizes
    out = np.zeros((deepest, len(lengths)), dtype=np.uint32)
    for t in range(deepest):
        x = state[: busy[t]]
        slot = x & np.uint64((1 << SCALE) - 1)
        s = table.symbol[slot.astype(np.int64)]
        out[t, : busy[t]] = s
        x[:] = table.freq[s] * (x >> np.uint64(SCALE)) + slot - table.base[s]
        low = np.flatnonzero(x < LEAST)
        x[low] = x[low] << np.uint64(32) | words[at[low]]
        at[low] += 1
    back = np.empty_like(out)
    back[:, order] = out
    back = back.reshape(deepest, -1, LANES)
    return [back[:, i].ravel()[:n] for i, n in enumerate(counts)]


def pack_block(ids: list[int | None], docs: list[np.ndarray], states: np.ndarray, lanes: list[np.ndarray]) -> bytes:
    sizes = [len(d) for d in docs]
    body = b"".join([
        struct.pack("<III", len(ids), sum(sizes), ids.count(None)), np.array([i or 0 for i in ids], "<i8").tobytes(), np.array(sizes, "<u4").tobytes(),
        states.astype("<u8").tobytes(), np.array([len(x) for x in lanes], "<u4").tobytes(), *(x.astype("<u4").tobytes() for x in lanes),
    ])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(block: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Document ids, their lengths, states and lane words; a damaged block is an error."""
    body, (crc,) = block[:-4], struct.unpack("<I", block[-4:])
    if zlib.crc32(body) != crc:
        raise ValueError("token block is damaged: its checksum differs")
    n_docs, _, n_null = struct.unpack_from("<III", body)
    at = 12
    out = []
    for kind, n in (("<i8", n_docs), ("<u4", n_docs), ("<u8", LANES), ("<u4", LANES)):
        out.append(np.frombuffer(body, kind, n, at))
        at += out[-1].nbytes
    words = np.frombuffer(body, "<u4", offset=at)
    ids = pa.array(out[0], mask=np.arange(n_docs) < n_null)
    return ids, out[1].astype(np.int64), out[2], np.split(words, np.cumsum(out[3].astype(np.int64))[:-1])


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


def tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids): the stored ids of every document with the end id, as 16-bit integers where the vocabulary fits."""
    width = "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype=width).tobytes()
        encoder = worker_encoder(path, decoded=False)
        for batch in batches:
            for step in steps(batch, "text"):
                made = encoder.id_bytes(step.column(1))
                ids = [np.frombuffer(m, "<u4").astype(width).tobytes() + end for m in made]
                yield pa.RecordBatch.from_arrays([step.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")), width


def _histogram(tokens: DataFrame, width: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, dtype=np.int64)
        for batch in batches:
            n = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), width))
            if len(n) > len(total):
                n[: len(total)] += total
                total = n
            else:
                total[: len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int, file_tokens: int = FILE_TOKENS) -> tuple[DataFrame, Table]:
    """Encode the documents and write them to ``folder``; returns the blocks (part, file, block, offset, bytes,
    n_tokens) and the frequency table, which is also written as ``frequencies``. Null texts are empty, rows with the
    same doc_id follow each other in the order of their ids, null doc_ids come first; an empty table has no blocks."""
    spark: SparkSession = docs.sparkSession
    tokens, width = tokenised(docs, path, end_id)
    seen = _histogram(tokens, width).toArrow()  # at most one row for each entry of the vocabulary
    counts = np.zeros(int(seen["id"].to_numpy().max(initial=0)) + 1, dtype=np.int64)
    counts[seen["id"].to_numpy()] = seen["n"].to_numpy()
    table = Table(counts)
    system, at = _filesystem(folder)
    system.create_dir(at, recursive=True)
    with system.open_output_stream(f"{at}/frequencies") as out:
        out.write(table.freq.astype("<u4").tobytes())
    sent = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}.rans"
        system, at = _filesystem(folder)
        whole, rows, offset = f"{at}/.{name}.{uuid.uuid4().hex}", [], len(MAGIC)
        pending: list[tuple[list[int | None], list[np.ndarray]]] = [([], [])]
        with system.open_output_stream(whole) as out:
            out.write(MAGIC)

            def flush() -> None:
                nonlocal offset
                ready = [p for p in pending if p[0]]
                if ready:
                    flat = [np.concatenate(d) for _, d in ready]
                    states, lanes = encode_blocks(sent.value, flat)
                    for i, (ids, own) in enumerate(ready):
                        block = pack_block(ids, own, states[i], lanes[i * LANES : (i + 1) * LANES])
                        out.write(block)
                        rows.append((offset, len(block), len(flat[i])))
                        offset += len(block)
                pending[:] = [([], [])]

            filled = 0
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    pending[-1][0].append(doc_id)
                    pending[-1][1].append(np.frombuffer(ids, width).astype(np.int64))
                    filled += len(pending[-1][1][-1])
                    if filled >= BLOCK_TOKENS:
                        filled = 0
                        if len(pending) >= GROUP:
                            flush()
                        else:
                            pending.append(([], []))
            flush()
            out.write(np.array(rows, "<u8").tobytes() + struct.pack("<Q", offset) + MAGIC)
        # Another attempt of this task has written the same bytes.
        system.move(whole, f"{at}/{name}")
        got = np.array(rows, dtype=np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(rows), pa.int32()), pa.array([name] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int32()), *(pa.array(got[:, i]) for i in range(3))],
            names=["part", "file", "block", "offset", "bytes", "n_tokens"],
        )

    files = max(1, -(-int(counts.sum()) // file_tokens))
    ranged = tokens.repartitionByRange(files, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    return stored(ranged.mapInArrow(run, "part int, file string, block int, offset long, bytes long, n_tokens long")), table


def read_token_files(blocks: DataFrame, table: Table, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document, decoded from the files block by block; ids are little-endian unsigned
    32-bit integers, start counts the ids of all documents before it."""
    sent = blocks.sparkSession.sparkContext.broadcast(table)
    in_file = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("file_start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = blocks.withColumn("start", F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0))).join(files.select("part", "file_start"), "part")
    placed = placed.select("file", "offset", "bytes", "n_tokens", (F.col("start") + F.col("file_start")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = _filesystem(folder)
        for batch in batches:
            rows = batch.to_pylist()
            for low in range(0, len(rows), GROUP):
                group, heads = rows[low : low + GROUP], []
                for row in group:
                    with system.open_input_file(f"{at}/{row['file']}") as file:
                        heads.append(unpack_block(file.read_at(row["bytes"], row["offset"])))
                made = decode_blocks(
                    sent.value, np.array([r["n_tokens"] for r in group]), np.stack([h[2] for h in heads]), [lane for h in heads for lane in h[3]]
                )
                for row, (ids, sizes, _, _), tokens in zip(group, heads, made):
                    ends = np.cumsum(sizes)
                    raw = tokens.astype("<u4").tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(row["start"] + ends - sizes), pa.array([raw[4 * (e - n) : 4 * e] for e, n in zip(ends, sizes)], pa.binary())],
                        names=["doc_id", "start", "ids"],
                    )

    # Blocks are spread by a given number, which adaptive execution keeps: their rows are tiny, what they stand for is not.
    tasks = max(1, -(-blocks.count() // GROUP))
    return placed.repartition(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write the token files to the shared folder and read them back."""
    folder = shared_folder(docs.sparkSession)
    blocks, table = write_token_files(docs, path, folder, end_id)
    return read_token_files(blocks, table, folder)
