"""BPE encoding and decoding by tree concatenation.

A text of more than ``piece`` characters is halved until its pieces are short enough. The pieces are spread over
tasks and encoded on their own. A tree then joins neighbours: a window around the join is encoded again and grows
until it gives a token of the left side before the join and one of the right side after it, with the same id at the
same place. Encoding is decided between neighbouring tokens only, so what lies beyond such a token stays as it was; a
window that reaches both ends is the whole text. Shorter texts are encoded in place.

White space never stands within a token of this kind of vocabulary, so a text is encoded as the row of its words, and
an encoder does each word it meets once.
"""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import bound_batches
from pagemill.llm.textops import NOT_SPACE, buffers, spans, steps

#: Texts of more characters are encoded in pieces of at most so many.
PIECE = 32_768
#: Characters on either side of a join that are encoded again at first.
REACH = 64
#: Bytes of words of which an encoder keeps the encoding, about; it starts anew beyond that.
KEPT_BYTES = 96 << 20
#: The same for an encoder that keeps ids only.
KEPT_IDS_BYTES = 160 << 20


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=4)
def names(path: str) -> tuple[dict[int, bytes], set[int]]:
    """The tokens by id, and which of them close a word."""
    found = {i: t.encode() for t, i in tokenizer(path).get_vocab(with_added_tokens=True).items()}
    return found, {i for i, t in found.items() if t.endswith(b"</w>")}


@lru_cache(maxsize=4)
def lean(path: str):
    """The same merges for lower-case ASCII words between spaces, which the normaliser and the pre-tokenizer leave as
    they are; the tokenizer itself if it treats such words of its vocabulary in another way."""
    from tokenizers import Tokenizer, pre_tokenizers

    whole, made = tokenizer(path), Tokenizer(tokenizer(path).model)
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    words = {t.removesuffix("</w>") for t in whole.get_vocab(with_added_tokens=True)}
    text = " ".join(sorted(w for w in words if w.isascii() and w.isalpha() and w.islower()))
    same = made.encode(text, add_special_tokens=False).ids == whole.encode(text, add_special_tokens=False).ids
    return made if same else whole


_MARKS = b".,;:!?"


def stem(word: bytes) -> tuple[bytes, bytes]:
    """A word's part that is encoded and kept, and the closing marks that are a token run of their own.

    Marks after a letter or digit never share a token with it. ASCII letters and digits alone are lower-cased, as the
    tokenizer does; other words aren't, because normalisation may combine their characters first.
    """
    base = word.rstrip(_MARKS)
    if len(base) < len(word) and not (base and (base[-1:].isalnum() or base[-1] > 127 and (last := base.decode()[-1]).isalpha() and last.lower().isalpha())):
        base = word
    return (base.lower() if base.isalnum() else base), word[len(base) :]


class Encoder:
    """Encodes UTF-8 texts word by word; ids are little-endian unsigned 32-bit integers. Without ``decoded`` it keeps the
    ids of words only, of about twice as many words."""

    def __init__(self, path: str, keep: int = KEPT_BYTES, decoded: bool = True):
        self.tokenizer, self.lean, self.keep, self.held, self.decoded = tokenizer(path), lean(path), keep, 0, decoded
        self.names, closing = names(path)
        self.closing = np.zeros(max(self.names, default=0) + 1, dtype=bool)
        self.closing[list(closing)] = True
        self.ids: dict[bytes, bytes] = {}
        self.tokens: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        if self.held > self.keep:
            self.ids.clear()
            self.tokens.clear()
            self.held = 0
        ids, tokens, before = self.ids, self.tokens, len(self.ids)
        unknown = words.difference(ids)
        plain = [w for w in unknown if w.isalnum()]
        cut = [(w, *stem(w)) for w in unknown.difference(plain)]
        new = {w.lower() for w in plain}.union(*(parts for _, *parts in cut)).difference(ids, (b"",))
        ascii = [w for w in new if w.isalpha()]
        for tok, some in ((self.lean, ascii), (self.tokenizer, list(new.difference(ascii)))):
            for at in range(0, len(some), 20_000):
                self._keep(tok, some[at : at + 20_000])
        cut += [(w, w.lower(), b"") for w in plain if not w.islower()]
        for word, base, marks in cut:
            if marks:
                ids[word] = ids[base] + ids[marks]
            elif word != base:
                ids[word] = ids[base]
        if self.decoded:
            for word, base, marks in cut:
                if marks:
                    tokens[word] = b" ".join(filter(None, (tokens[base], tokens[marks])))
                elif word != base:
                    tokens[word] = tokens[base]
        # A table entry, a key and a value with their headers, and the same for the tokens; long words add their own length.
        self.held += (320 if self.decoded else 180) * (len(ids) - before) + sum(len(w) for w in unknown if len(w) > 16)

    def _keep(self, tok, words: list[bytes]) -> None:
        """The ids of each word. Words of letters alone are encoded as one text and told apart by their closing tokens."""
        plain = [w for w in words if w.isalpha() or not w.isascii() and (t := w.decode()).isalpha() and t.lower().isalpha()]
        together = tok.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)[0].ids
        flat = np.array(together, dtype="<u4")
        ends = np.flatnonzero(self.closing[flat]) + 1
        if len(ends) == len(plain):
            raw, stops = flat.tobytes(), ends.tolist()
            self.ids.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(plain, [0, *stops], stops))
            if self.decoded:
                shown = [self.names[i] for i in together]
                self.tokens.update((w, b" ".join(shown[a:b])) for w, a, b in zip(plain, [0, *stops], stops))
            if len(plain) == len(words):
                return
            words = list(set(words).difference(plain))
        made = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        for word, one in zip(words, made):
            self.ids[word] = struct.pack(f"<{len(one.ids)}I", *one.ids)
            if self.decoded:
                self.tokens[word] = b" ".join([self.names[i] for i in one.ids])

    def id_bytes(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a column; every word of it is looked up once."""
        data, offsets = buffers(texts)
        start, stop = spans(data, offsets, NOT_SPACE)
        first = np.searchsorted(start, offsets)
        ends = np.append(0, np.cumsum(stop - start))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[NOT_SPACE[data]])]
        ).dictionary_encode()
        known = rows_of(words.dictionary)
        self.learn(set(known))
        known = [self.ids[w] for w in known]
        ends = np.append(0, np.cumsum([len(x) for x in known])).astype(np.int64)
        known = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(known), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(known))])
        raw, ends = buffers(known.take(words.indices))
        raw, at = raw.tobytes(), ends[first].tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids and decoded text of each text."""
        split = [t.split() for t in texts]
        self.learn(set().union(*split))
        ids, tokens = self.ids.__getitem__, self.tokens.__getitem__
        return [(b"".join(map(ids, words)), b" ".join(filter(None, map(tokens, words)))) for words in split]


@lru_cache(maxsize=1)
def worker_encoder(path: str, decoded: bool = True) -> Encoder:
    """An encoder that the worker keeps for its next tasks."""
    return Encoder(path, KEPT_BYTES if decoded else KEPT_IDS_BYTES, decoded)


def rows_of(column: pa.Array) -> list[bytes]:
    data, offsets = buffers(column)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def safe_cut(text: str, at: int) -> int:
    """The next place from ``at`` where normalisation doesn't reach across: not before a mark or a joining jamo."""
    while at < len(text) and (unicodedata.category(text[at])[0] == "M" or "ᅠ" <= text[at] <= "ᇿ"):
        at += 1
    return at


def halves(text: str, piece: int) -> list[str]:
    """The text in pieces of about ``piece`` characters at most, by halving."""
    if len(text) <= piece:
        return [text]
    cut = safe_cut(text, len(text) // 2)
    if cut >= len(text):
        return [text]
    return halves(text[:cut], piece) + halves(text[cut:], piece)


class Part:
    """An encoded stretch of text: ids, and the place of each token in it."""

    def __init__(self, text: str, ids: np.ndarray, start: np.ndarray, stop: np.ndarray):
        self.text, self.ids, self.start, self.stop = text, ids, start, stop

    @classmethod
    def of(cls, tok, text: str) -> Part:
        made = tok.encode(text, add_special_tokens=False)
        spans = np.array(made.offsets, dtype=np.int64).reshape(-1, 2)
        return cls(text, np.array(made.ids, dtype=np.int64), spans[:, 0], spans[:, 1])

    def anchors(self, low: int, high: int, shift: int = 0) -> dict[tuple[int, int, int], int]:
        """Tokens within [low, high) that share no character with a neighbour: (id, start, stop) to number."""
        first, last = np.searchsorted(self.start, low), np.searchsorted(self.start, high)
        at = np.arange(first, last)
        alone = (self.stop[at] <= high) & (self.stop[at] > self.start[at])
        alone &= (at == 0) | (self.stop[at - 1] <= self.start[at])
        alone &= (at == len(self.ids) - 1) | (self.start[np.minimum(at + 1, len(self.ids) - 1)] >= self.stop[at])
        return {(int(self.ids[i]), int(self.start[i]) + shift, int(self.stop[i]) + shift): int(i) for i in at[alone]}


def join(tok, left: Part, right: Part, reach: int = REACH) -> Part:
    """The encoding of both texts as one. The window is never shorter than a special token on either side."""
    text, at = left.text + right.text, len(left.text)
    reach = max(reach, *(len(t.content) for t in tok.get_added_tokens_decoder().values()), 1)
    while True:
        low = safe_cut(text, max(0, at - reach)) if at > reach else 0
        high = safe_cut(text, at + reach) if at + reach < len(text) else len(text)
        low = low if low < at else 0
        window = Part.of(tok, text[low:high])
        if low == 0 and high == len(text):
            return Part(text, window.ids, window.start, window.stop)
        own = window.anchors(0, high - low, low)
        before = {k: i for k, i in left.anchors(low, at).items() if k in own} if low else {None: -1}
        after = {k: i for k, i in right.anchors(0, high - at, at).items() if k in own} if high < len(text) else {None: len(right.ids)}
        if before and after:
            a, b = min(before, key=before.get), max(after, key=after.get)
            keep, go = before[a] + 1, after[b]
            first, last = own[a] + 1 if a else 0, own[b] if b else len(window.ids)
            return Part(text, *(
                np.concatenate([getattr(left, f)[:keep], getattr(window, f)[first:last] + low * (f != "ids"), getattr(right, f)[go:] + at * (f != "ids")])
                for f in ("ids", "start", "stop")
            ))
        reach *= 2


def tree(tok, parts: list[Part], reach: int = REACH) -> Part:
    """Neighbours joined level by level."""
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [join(tok, *pair, reach) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]


def encode(docs: DataFrame, path: str, columns: list[str] | None = None, piece: int = PIECE, keep_words: bool = True) -> DataFrame:
    """``docs`` (or the ``columns`` of it) with ids (binary, little-endian unsigned 32-bit) and decoded (string).

    A null or empty text has no ids and decodes to the empty text. Every row is encoded for itself, so repeated rows,
    null ids and other columns don't matter; columns named ids or decoded are replaced. Only texts of more than ``piece`` characters are shuffled. Workers keep
    words for their next tasks, unless ``keep_words`` is false: then each task starts empty and leaves nothing behind.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c not in ("ids", "decoded")]
    bound_batches(docs.sparkSession)
    read = docs.select(F.struct(*columns).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    kind = read.schema["row"].dataType.simpleString()
    is_long = F.length("text") > piece

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path) if keep_words else Encoder(path)
        for batch in batches:
            for step in steps(batch, "text"):
                made = encoder.encode(rows_of(step.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), pa.array([m[0] for m in made], pa.binary()), pa.array([m[1].decode() for m in made], pa.string())],
                    names=["row", "ids", "decoded"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                for i, text in enumerate(step.column(2).to_pylist()):
                    parts = halves(text, piece)
                    at = pa.array([i] * len(parts), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [step.column(0).take(at), step.column(1).take(at), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())],
                        names=["id", "row", "seq", "text"],
                    )

    def halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                made = [Part.of(tokenizer(path), t) for t in step.column(3).to_pylist()]
                packed = [pa.array([getattr(p, f).astype("<u4").tobytes() for p in made], pa.binary()) for f in ("ids", "start", "stop")]
                yield pa.RecordBatch.from_arrays([*step.columns, *packed], names=["id", "row", "seq", "text", "ids", "start", "stop"])

    def joined(group: pa.Table) -> pa.Table:
        rows = sorted(group.select(["seq", "text", "ids", "start", "stop"]).to_pylist(), key=lambda r: r["seq"])
        parts = [Part(r["text"], *(np.frombuffer(r[f], dtype="<u4").astype(np.int64) for f in ("ids", "start", "stop"))) for r in rows]
        ids = tree(tokenizer(path), parts).ids
        text = tokenizer(path).decode(ids.tolist(), skip_special_tokens=False)
        return pa.table([group["row"].slice(0, 1), pa.array([ids.astype("<u4").tobytes()], pa.binary()), pa.array([text], pa.string())], names=["row", "ids", "decoded"])

    short = read.where(~is_long).mapInArrow(whole, f"row {kind}, ids binary, decoded string")
    pieces = read.where(is_long).select(F.monotonically_increasing_id().alias("id"), "row", "text").mapInArrow(
        cut, f"id long, row {kind}, seq int, text string"
    )
    pieces = pieces.repartition("id", "seq").mapInArrow(
        halved, f"id long, row {kind}, seq int, text string, ids binary, start binary, stop binary"
    )
    long = pieces.groupBy("id").applyInArrow(joined, f"row {kind}, ids binary, decoded string")
    return short.union(long).select("row.*", "ids", "decoded")
