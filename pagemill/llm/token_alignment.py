"""Cross-tokenizer alignment with exact-text deduplication.

Texts are shuffled by their full text, so each distinct one is tokenised and aligned once, however many documents hold it,
and its pairs of ids count as often as documents do. Measures go back to documents by the text's digest.

What a text needs of the corpus are the counts of its id pairs. Texts are packed into blocks, and a block asks once for
each pair that it holds: the counts are sums over blocks, the answers one join by pair and one by block, so a pair that
every text has is met once for each block and never once for each document.

Both tokenizers always cut before a space that follows a character which is no white space. Such units are aligned on their
own, and a task does each unit it meets once. A text with a unit that doesn't come back as its own bytes is done whole.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import bound_batches, stored
from pagemill.llm.textops import steps

#: Bytes of units of which a task keeps the alignment, about; it starts anew beyond that.
KEPT_BYTES = 64 << 20
#: Pairs that the texts of a block hold together, about; a text is never divided.
BLOCK_PAIRS = 3_000_000
#: A text that at least one in so many documents holds is joined over SALTS keys.
HOT, SALTS = 1000, 64
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies show printable bytes as themselves and the others as characters from 256 on, in order."""
    shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, and the bytes that each of their ids stands for."""

    def __init__(self, path_a: str, path_b: str, pattern: str | None = None):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        table = byte_of_character()
        names = self.a.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes_a[i] = name.encode() if name in special else bytes(map(table.__getitem__, name))
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        every = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.written, self.written_bar, self.written_semicolon, self.written_bare = (np.array([f"{i}{sign}" for i in every], dtype=object) for sign in (",", "|", ";", ""))

        self.ranks = self._as_ranks(json.loads(self.a.to_str())["model"], pattern)

    def _as_ranks(self, model: dict, pattern: str | None):
        """The first tokenizer's merges as ranks, where ids ascend in the order of the merges; encodes long
        ASCII several times faster. Other text stays with its own library, whose character classes may be of another Unicode version."""
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
        order = [model["vocab"][m] for m in merged]
        if pattern is None or order != sorted(set(order)) or len(order) + 256 + len(self.a.get_added_tokens_decoder()) != len(self.bytes_a):
            return None
        import tiktoken

        special = set(self.a.get_added_tokens_decoder())
        ranks = {raw: i for i, raw in enumerate(self.bytes_a) if i not in special}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def first(self, spaced: list[str]) -> list[bytes]:
        """The first tokenizer's ids, packed. ASCII units are strung together and cut apart at their bytes, which only works
        where none ends in white space."""
        joined = [self.ranks is not None and s.isascii() and not s[-1:].isspace() for s in spaced]
        own = [s for s, j in zip(spaced, joined) if j]
        flat = np.array(self.ranks.encode_ordinary("".join(own)) if own else [], dtype="<i4")
        ends = np.searchsorted(np.cumsum(self.sizes_a[flat]), np.cumsum([len(s) for s in own])) + 1
        raw, starts = flat.tobytes(), [0, *ends[:-1].tolist()]
        cut = iter([raw[4 * a : 4 * b] for a, b in zip(starts, ends.tolist())])
        made = self.a.encode_batch_fast([s for s, j in zip(spaced, joined) if not j], add_special_tokens=False)
        other = iter([struct.pack(f"<{len(one.ids)}i", *one.ids) for one in made])
        return [next(cut) if j else next(other) for j in joined]

    def encode(self, spaced: list[str]) -> Iterator[tuple[bytes, list[int]]]:
        """Ids of both of texts with a space before them, which the second tokenizer adds by itself."""
        return zip(self.first(spaced), self.b.encode([s[1:] for s in spaced], num_threads=1))


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str, pattern: str | None = None) -> Tokenizers:
    return Tokenizers(path_a, path_b, pattern)


def units(text: str) -> list[str]:
    """A space and the text, cut before each space that follows no white space."""
    out, held = [], ""
    for piece in text.split(" "):
        if piece and not piece[-1].isspace():
            out.append(f"{held} {piece}")
            held = ""
        else:
            held = f"{held} {piece}"
    if held:
        out.append(held)
    return out


class Aligner:
    """Tokenises texts unit by unit, each unit it meets once, and aligns the texts of a step together."""

    def __init__(self, path_a: str, path_b: str, pattern: str | None = None, keep: int = KEPT_BYTES):
        self.of, self.keep = tokenizers(path_a, path_b, pattern), keep
        self.width = self.of.b.get_piece_size()
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.held = 0

    def _checked(self, spaced: str, a: bytes, b: list[int]) -> tuple[bytes, bytes] | None:
        """Both id lists, packed; None where the tokens don't join to the text. ASCII always comes back from byte-level
        tokens, so there only the second list is looked at."""
        of, raw = self.of, spaced.encode()
        if b"".join([of.bytes_b[i] for i in b]) != raw:
            return None
        if len(raw) != len(spaced) and b"".join([of.bytes_a[i] for i in memoryview(a).cast("i")]) != raw:
            return None
        return a, struct.pack(f"<{len(b)}i", *b)

    def learn(self, new: set[str]) -> None:
        if self.held > self.keep:
            self.known.clear()
            self.held = 0
        todo = list(new.difference(self.known))
        for low in range(0, len(todo), 10_000):
            part = todo[low : low + 10_000]
            for unit, (a, b) in zip(part, self.of.encode(part)):
                self.known[unit] = self._checked(unit, a, b)
                self.held += 300 + 2 * len(unit) + len(a) + 4 * len(b)

    def ids(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Both id lists of each text; None where it has no tokens."""
        cut = [units(t) if t else [] for t in texts]
        self.learn(set().union(*cut))
        out: list[tuple[bytes, bytes] | None] = []
        for text, own in zip(texts, cut):
            parts = [self.known[u] for u in own]
            if None in parts:
                parts = [self._checked(f" {text}", *next(iter(self.of.encode([f" {text}"]))))]
            out.append((b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])) if parts and None not in parts else None)
        return out

    def measure(self, texts: list[str]) -> Iterator[tuple[tuple[int, ...], bytes, np.ndarray, np.ndarray]]:
        """For each text its COUNTS, the digest of its groups (empty without tokens), and its pairs with their links."""
        found = self.ids(texts)
        with_tokens = [f for f in found if f is not None]
        aligned = iter(aligned_texts(with_tokens, self.of, self.width))
        none = np.zeros(0, np.int64)
        for f in found:
            yield ((0, 0, 0, 0), b"", none, none) if f is None else next(aligned)


def aligned_texts(texts: list[tuple[bytes, bytes]], of: Tokenizers, width: int) -> Iterator[tuple[tuple[int, ...], bytes, np.ndarray, np.ndarray]]:
    """Texts by their ids, aligned at once: the ends of both sides' tokens cut the bytes into segments, each within one
    token of either side. So there is a link for each segment, and a group ends where a token of both does."""
    if not texts:
        return
    a, b = (np.frombuffer(b"".join([t[i] for t in texts]), "<i4") for i in (0, 1))
    last_a, last_b = (np.cumsum([len(t[i]) // 4 for t in texts]) for i in (0, 1))
    end_a, end_b = np.cumsum(of.sizes_a[a]), np.cumsum(of.sizes_b[b])
    both = np.sort(np.concatenate([end_a, end_b]), kind="stable")
    shared = both[1:] == both[:-1]
    cuts, ends = both[np.append(True, ~shared)], both[1:][shared]
    keys = a[np.searchsorted(end_a, cuts)].astype(np.int64) * width + b[np.searchsorted(end_b, cuts)]
    # Where each text stops among segments and groups; a text's end is the end of a group.
    stop = end_a[last_a - 1]
    last_cut, last_group = np.searchsorted(cuts, stop) + 1, np.searchsorted(ends, stop) + 1
    shown = _groups_text(a, b, end_a, end_b, ends, stop, of)
    pieces = last_a + last_b
    first_a = first_b = first_cut = first_group = first_piece = 0
    for i in range(len(texts)):
        counts = (int(last_a[i] - first_a), int(last_b[i] - first_b), int(last_group[i] - first_group), int(last_cut[i] - first_cut))
        digest = hashlib.sha256("".join(shown[first_piece : pieces[i]]).encode()).digest()
        yield counts, digest, *np.unique(keys[first_cut : last_cut[i]], return_counts=True)
        first_a, first_b, first_cut, first_group, first_piece = last_a[i], last_b[i], last_cut[i], last_group[i], pieces[i]


def _groups_text(a, b, end_a, end_b, ends, stop, of: Tokenizers) -> list[str]:
    """Every token as written among its group: all ids of one side, then all of the other, with the sign that follows."""
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
    out = np.empty(len(a) + len(b), dtype=object)
    at_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
    at_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
    out[at_a], out[at_b] = of.written[a], of.written[b]
    closes_a, closes_b = end_a == ends[group_a], end_b == ends[group_b]
    out[at_a[closes_a]] = of.written_bar[a[closes_a]]
    out[at_b[closes_b]] = of.written_semicolon[b[closes_b]]
    last = np.flatnonzero(np.isin(end_b, stop, assume_unique=True))
    out[at_b[last]] = of.written_bare[b[last]]
    return out.tolist()


def packed(values: np.ndarray) -> bytes:
    """Numbers below 2**32, mostly small: byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _blocks(texts: DataFrame, path_a: str, path_b: str, pattern: str | None, block_pairs: int) -> DataFrame:
    """Texts (text, digest, n) as blocks: their measures, their pairs as places in ``need``, and for each pair of
    ``need`` how many documents of the block hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, part, made = Aligner(path_a, path_b, pattern), TaskContext.get().partitionId(), 0
        rows: list[tuple] = []

        def block() -> pa.RecordBatch:
            sizes = np.array([len(r[4]) for r in rows])
            need, at = np.unique(np.concatenate([r[4] for r in rows]), return_inverse=True)
            weight = np.zeros(len(need), dtype=np.int64)
            np.add.at(weight, at, np.repeat(np.array([r[1] for r in rows], dtype=np.int64), sizes))
            step = np.diff(at, prepend=0)
            starts = (np.cumsum(sizes) - sizes)[sizes > 0]
            step[starts] = at[starts]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | made]), pa.array([b"".join(r[0] for r in rows)]), pa.array([np.array([r[1] for r in rows], "<i8").tobytes()]),
                    pa.array([np.array([r[2] for r in rows], "<i8").tobytes()]), pa.array([b"".join(r[3] or bytes(32) for r in rows)]),
                    pa.array([packed(sizes)]), pa.array([packed(step)]), pa.array([packed(np.concatenate([r[5] for r in rows]))]),
                    pa.array([need], pa.list_(pa.int64())), pa.array([weight], pa.list_(pa.int64())),
                ],
                names=names,
            )

        filled = 0
        for batch in batches:
            for step in steps(batch, "text"):
                measured = aligner.measure(step.column(0).to_pylist())
                for digest, n, (counts, groups, pairs, links) in zip(step.column(1).to_pylist(), step.column(2).to_pylist(), measured):
                    rows.append((digest, n, counts, groups, pairs, links))
                    filled += len(pairs) + 100
                    if filled >= block_pairs:
                        yield block()
                        rows, filled, made = [], 0, made + 1
        if rows:
            yield block()

    names = ["block", "digests", "copies", "counts", "groups", "sizes", "at", "links", "need", "weight"]
    binary = "".join(f"{c} binary, " for c in names[1:8])
    return stored(texts.select("text", "digest", "n").mapInArrow(run, f"block long, {binary}need array<long>, weight array<long>"))


def alignment(docs: DataFrame, path_a: str, path_b: str, pattern: str | None = None, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A space and the text are encoded by both tokenizers without special tokens; ``pattern`` is the first one's splitting
    pattern, with which ASCII is encoded by its merges as ranks (without it by its own library, with the same ids). Places where tokens of both end cut them
    into groups; links are the pairs of tokens whose bytes overlap. The count of an id pair is the number of rows that hold
    it; count_sum adds it over a row's links, n_best counts links of which it is the highest of the first id (ties
    included). Texts that are null, empty or don't come back as their bytes have no tokens: zeros and an empty
    groups_sha256. Repeated rows and copies count each; doc_id may be null or repeated, other columns are ignored, and an
    empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("n")).select("text", digest, "n")
    blocks = _blocks(texts, path_a, path_b, pattern, block_pairs)
    width = tokenizers(path_a, path_b).b.get_piece_size()

    asked = blocks.select(F.col("block").alias("asker"), F.explode(F.arrays_zip("need", "weight")).alias("of")).select("asker", F.col("of.need").alias("pair"), F.col("of.weight").alias("weight"))
    counted = asked.groupBy("pair").agg(F.sum("weight").alias("count")).withColumn("a", F.expr(f"pair div {width}"))
    # One id has at most as many pairs as the second vocabulary has ids.
    highest = F.max("count").over(Window.partitionBy("a"))
    scored = counted.select("pair", "count", (F.col("count") == highest).alias("best"))
    answers = asked.select("asker", "pair").join(scored, "pair")

    def add(blocks: pa.Table, found: pa.Table) -> pa.Table:
        row = {c: blocks[c][0].as_py() for c in blocks.column_names if c not in ("need", "weight")}
        sizes, step, links = (unpacked(row[c]) for c in ("sizes", "at", "links"))
        # The block's pairs are the answered ones, so the order of the answers is the order of ``need``.
        order = np.argsort(found["pair"].to_numpy())
        count, best = found["count"].to_numpy()[order], found["best"].to_numpy()[order]
        ends = np.cumsum(sizes)
        total = np.cumsum(step)
        full = sizes > 0
        # Steps are running differences that start anew with each text.
        started = np.zeros(len(sizes), dtype=np.int64)
        started[full] = total[(ends - sizes)[full]] - step[(ends - sizes)[full]]
        at = total - np.repeat(started, sizes)
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (links * count[at], links * best[at])]
        per = [s[ends] - s[ends - sizes] for s in sums]
        n = len(sizes)
        cut = lambda c: [row[c][i : i + 32] for i in range(0, 32 * n, 32)]
        counts = np.frombuffer(row["counts"], "<i8").reshape(n, 4)
        return pa.table(
            [pa.array(cut("digests")), pa.array(np.frombuffer(row["copies"], "<i8")), *(pa.array(counts[:, i]) for i in range(4)), pa.array(per[1]), pa.array(per[0]), pa.array(cut("groups"))],
            names=["digest", "n", *COUNTS, "n_best", "count_sum", "groups"],
        )

    kinds = "".join(f"{c} long, " for c in ("n", *COUNTS, "n_best", "count_sum"))
    measures = stored(
        blocks.drop("need", "weight").groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(add, f"digest binary, {kinds}groups binary")
    )
    # Texts that many documents hold are at most HOT, so their digests may go to every task; their rows are spread.
    rows = measures.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT >= F.lit(rows)
    hot = F.broadcast(measures.where(is_hot).select("digest", F.lit(True).alias("hot")))
    spread = measures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(is_hot, SALTS - 1).otherwise(0)))).drop("n")
    keyed = docs.select("doc_id", digest, F.monotonically_increasing_id().alias("row")).join(hot, "digest", "left")
    keyed = keyed.select("doc_id", "digest", F.when(F.col("hot"), F.pmod("row", F.lit(SALTS))).otherwise(0).cast("int").alias("salt"))
    found = keyed.join(spread, ["digest", "salt"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*COUNTS, "n_best", "count_sum")]
    shown = F.when(F.col("n_a") > 0, F.lower(F.hex("groups"))).otherwise("")
    return found.select("doc_id", *zero, shown.alias("groups_sha256"))
