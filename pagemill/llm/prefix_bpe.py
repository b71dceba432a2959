"""Byte-level BPE by prefix dynamic programming over a rank file.

The text is cut by the vocabulary's pattern, and each match is encoded on its own. Of the tokens that can end at a byte of
a match exactly one is the last token of the encoding of the match up to that byte: the one that fits to the last token of
the prefix before it. These last tokens are stored, one for each byte (``last``). The ids of any prefix are read off by
walking back, so more bytes go on where the stored ones end, and after an edit only the bytes near it are done again: once
the last tokens of as many bytes as the longest token has agree with the stored ones, all later ones do.

Two tokens fit when no merge across the cut between them would have come before a merge that built one of them.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import bound_batches
from pagemill.llm.textops import steps

#: Bytes of matches of which a task keeps the encoding, about; it starts anew beyond that.
KEPT_BYTES = 48 << 20
#: Pairs of tokens of which a vocabulary keeps whether they fit.
KEPT_PAIRS = 200_000
#: Characters that the pattern looks at beyond a match at most.
AHEAD = 2


class Vocabulary:
    """The ranks of a file: which tokens there are, how each was merged, and which stand side by side."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(token): int(n) for token, n in map(bytes.split, lines)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, n in self.rank.items():
            self.token[n] = token
        self.longest = max(map(len, self.rank))
        #: The longest token that ends in three given bytes; tokens of one and two bytes end in any.
        self.tails: dict[bytes, int] = {}
        for token in self.rank:
            if len(token) > 2:
                self.tails[token[-3:]] = max(len(token), self.tails.get(token[-3:], 0))
        self._halves: dict[int, tuple[int, int]] = {}
        self._fits: dict[int, bool] = {}

    def halves(self, n: int) -> tuple[int, int]:
        """The two tokens whose merge made token n, found by merging its bytes with lower ranks only."""
        made = self._halves.get(n)
        if made is None:
            rank, parts = self.rank, [bytes([b]) for b in self.token[n]]
            while len(parts) > 2:
                found, at = min((rank.get(parts[i] + parts[i + 1], n), i) for i in range(len(parts) - 1))
                if found >= n:
                    raise ValueError(f"token {n} cannot be reached by merges")
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            made = self._halves[n] = rank[parts[0]], rank[parts[1]]
        return made

    def fits(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is these two tokens."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= KEPT_PAIRS:
                self._fits.clear()
            known = self._fits[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        token, before = self.token, len(self.token)
        while True:
            across = self.rank.get(token[left] + token[right])
            if across is not None and across < before:
                return False
            made_left = left if len(token[left]) > 1 else -1
            made_right = right if len(token[right]) > 1 else -1
            if made_left < 0 and made_right < 0:
                return True
            # Take back the merge that came last. Of equal ranks the leftmost is merged first.
            if made_left > made_right:
                before, left = made_left, self.halves(left)[1]
            else:
                before, right = made_right + 1, self.halves(right)[0]

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> list[int]:
        """``last`` for the bytes of one match, going on where it ends."""
        find, fits, known, tails = self.rank.get, self.fits, self._fits.get, self.tails
        for end in range(len(last) + 1, (len(data) if stop is None else stop) + 1):
            # No token ends here that is longer than those that end in these last bytes.
            for start in range(max(0, end - tails.get(data[end - 3 : end], 2)) if end > 2 else 0, end):
                n = find(data[start:end])
                if n is None:
                    continue
                if start:
                    before = last[start - 1]
                    fit = known(before << 32 | n)
                    if not (fits(before, n) if fit is None else fit):
                        continue
                last.append(n)
                break
            else:
                raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")
        return last

    def ids(self, last: list[int]) -> list[int]:
        """The tokens of a match, from the last one back."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.token[last[at - 1]])
        return out[::-1]

    def spliced(self, data: bytes, old: list[int], same_start: int, same_end: int) -> list[int]:
        """``last`` of a match whose first ``same_start`` and last ``same_end`` bytes are those of a match with ``old``."""
        last, shift = old[:same_start], len(data) - len(old)
        agree, at = 0, len(last)
        while at < len(data):
            self.extend(data, last, at + 1)
            # A last token depends on the longest token's bytes and on as many last tokens before it.
            was = at - shift
            inside = at >= len(data) - same_end and 0 <= was < len(old)
            agree = agree + 1 if inside and old[was] == last[at] else 0
            at += 1
            if agree >= self.longest:
                return last + old[at - shift :]
        return last


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts match by match; each match it meets is done once."""

    def __init__(self, path: str, pattern: str, keep: int = KEPT_BYTES):
        self.vocabulary, self.pattern, self.keep = vocabulary(path), regex.compile(pattern), keep
        self.known: dict[str, np.ndarray] = {}
        self.held = 0

    def learn(self, matches: set[str]) -> None:
        """Encode new matches in the order of their bytes: each goes on from the prefix it shares with the one before."""
        known, voc = self.known, self.vocabulary
        before, last = b"", []
        for data in sorted(m.encode() for m in matches.difference(known)):
            same = len(commonprefix((before, data)))
            del last[same:]
            ids = voc.ids(voc.extend(data, last))
            known[data.decode()] = struct.pack(f"<{len(ids)}i", *ids)
            self.held += 150 + 2 * len(data) + 4 * len(ids)
            before = data

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers."""
        if self.held > self.keep:
            self.known.clear()
            self.held = 0
        cut = [self.pattern.findall(t) for t in texts]
        self.learn(set().union(*cut))
        ids = self.known.__getitem__
        return [b"".join(map(ids, matches)) for matches in cut]

    def prefixes(self, text: str) -> np.ndarray:
        """The stored last token of every byte's prefix within its match."""
        voc = self.vocabulary
        return np.array([n for m in self.pattern.findall(text) for n in voc.extend(m.encode(), [])], dtype=np.int32)

    def starts(self, text: str, at: int = 0) -> Iterator[tuple[int, int]]:
        for m in self.pattern.finditer(text, at):
            yield m.start(), m.end()

    def read_ids(self, text: str, last: np.ndarray) -> np.ndarray:
        """The ids of a text by its stored last tokens."""
        out, at, voc = [], 0, self.vocabulary
        for match in self.pattern.findall(text):
            size = len(match.encode())
            out += voc.ids(last[at : at + size].tolist())
            at += size
        return np.array(out, dtype=np.int32)

    def edit(self, text: str, last: np.ndarray, at: int, gone: int, added: str) -> tuple[str, np.ndarray]:
        """The text with ``gone`` characters from ``at`` on replaced, and its last tokens; only matches that the edit can
        reach are cut again, and of those only the bytes until the stored last tokens agree are done again."""
        at = min(max(at, 0), len(text))
        gone = min(max(gone, 0), len(text) - at)
        new, shift = text[:at] + added + text[at + gone :], len(added) - gone
        first = 0  # the first character whose match may change: matches that end AHEAD before the edit stay
        bounds = [b for b in self.starts(text)]
        for start, stop in bounds:
            if stop > at - AHEAD:
                break
            first = stop
        old_starts = {start: i for i, (start, _) in enumerate(bounds)}
        size = lambda t: len(t.encode())
        done, offset = [last[: size(text[:first])]], size(text[:first])
        rest = len(new)
        for start, stop in self.starts(new, first):
            if start - shift >= at + gone and start - shift in old_starts:
                rest = start
                break
            data = new[start:stop].encode()
            old: list[int] = []
            same_start = same_end = 0
            if start in old_starts and start <= at:
                was = bounds[old_starts[start]]
                begin = size(text[: was[0]])
                old = last[begin : begin + size(text[was[0] : was[1]])].tolist()
                same_start = min(len(old), len(data), size(new[start : max(start, min(at, stop))]))
                if was[1] + shift == stop and was[1] >= at + gone:
                    same_end = size(text[at + gone : was[1]])
            done.append(np.array(self.vocabulary.spliced(data, old, same_start, same_end), dtype=np.int32))
            offset += len(data)
        if rest < len(new):
            done.append(last[len(last) - size(new[rest:]) :])
        return new, np.concatenate(done).astype(np.int32)


def _tokens(encoder: Encoder, ids: bytes) -> bytes:
    return b"".join(map(encoder.vocabulary.token.__getitem__, np.frombuffer(ids, np.int32).tolist()))


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32))).cast(pa.list_(pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str, columns: list[str] | None = None, prefixes: bool = False) -> DataFrame:
    """``docs`` (or the ``columns`` of it) with ids (array<int>) and decoded (binary: the bytes the ids stand for).

    With ``prefixes`` also last (array<int>), the last token of every byte's prefix, for ``edited``. A null or empty text
    has no ids and decodes to no bytes. Every row is encoded for itself, so repeated rows, ties, null ids and other
    columns don't matter; columns named ids, decoded or last are replaced. Nothing is shuffled; an empty table gives an
    empty one.
    """
    made = ("ids", "decoded", "last")
    columns = [c for c in (docs.columns if columns is None else columns) if c not in made]
    bound_batches(docs.sparkSession)
    read = docs.select(F.struct(*columns).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    kind = read.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)  # kept for this task only
        for batch in batches:
            for step in steps(batch, "text"):
                texts = step.column(1).to_pylist()
                ids = encoder.encode(texts)
                out = [step.column(0), _lists(ids), pa.array([_tokens(encoder, i) for i in ids], pa.binary())]
                if prefixes:
                    out.append(_lists([encoder.prefixes(t).tobytes() for t in texts]))
                yield pa.RecordBatch.from_arrays(out, names=["row", *made][: len(out)])

    more = ", last array<int>" * prefixes
    return read.mapInArrow(run, f"row {kind}, ids array<int>, decoded binary{more}").select("row.*", *made[: 2 + prefixes])


def edited(encoded: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text, ids, last) of texts that ``encode`` gave prefixes for, after edits (doc_id, at, gone, added).

    An edit puts ``added`` in place of ``gone`` characters from ``at`` on; places beyond the text are its end, so an
    append is an edit at the end. Null counts as 0 or as no text. Every edit is applied alone: a document of two edits
    gives two rows, one without edits none. Null ids match nothing. The edits are joined by doc_id, and a text's cost
    beyond copying is that of the matches near its edit.
    """
    given = edits.select(
        "doc_id", F.coalesce(F.col("at").cast("long"), F.lit(0)).alias("at"),
        F.coalesce(F.col("gone").cast("long"), F.lit(0)).alias("gone"), F.coalesce("added", F.lit("")).alias("added"),
    )
    read = encoded.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "last").join(given, "doc_id")
    bound_batches(encoded.sparkSession)
    kind = read.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            for step in steps(batch, "text"):
                ids, texts, lasts = step.column(0), [], []
                for row in step.slice().to_pylist():
                    text, last = encoder.edit(row["text"], np.array(row["last"], dtype=np.int32), row["at"], row["gone"], row["added"])
                    texts.append(text)
                    lasts.append(last)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(texts, pa.string()), _lists([encoder.read_ids(t, x).tobytes() for t, x in zip(texts, lasts)]), _lists([x.tobytes() for x in lasts])],
                    names=["doc_id", "text", "ids", "last"],
                )

    return read.select("doc_id", "text", "last", "at", "gone", "added").mapInArrow(run, f"doc_id {kind}, text string, ids array<int>, last array<int>")
