"""Language ID by error-correcting output codes.

Every learned language has a codeword of bits. For each bit a binary classifier over hashed character trigrams
(naive Bayes; the trigram counts of each language are summed by Spark over all labelled rows) says which side a
text is on. Decoding takes the codeword with the least loss, each bit weighted by how well its classifier told the
training languages apart, and flags texts for which the choice is not clear.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import bound_batches
from pagemill.llm.textops import steps

#: Size of the hashed trigram space: bounds the model to languages x BUCKETS counts.
BUCKETS = 1 << 15
#: Trigrams after which more text of the same kind doesn't make a bit surer.
EVIDENCE = 40
#: A best codeword with less than this share of the decoding weight is ambiguous.
CLEAR = 0.6
UNKNOWN = "und"


def codewords(classes: int) -> np.ndarray:
    """A matrix of +1/-1, a row for each class: every split of the classes while these are few, else the random
    code of 10 log2(classes) bits with the best least distance among 64 (fixed seeds)."""
    if classes < 2:
        return np.ones((classes, 1), dtype=np.int8)
    if classes <= 6:
        splits = np.arange(2 ** (classes - 1), 2**classes - 1)
        return (1 - 2 * ((splits[None, :] >> np.arange(classes)[::-1, None]) & 1)).astype(np.int8)
    bits = math.ceil(10 * math.log2(classes))
    made = [np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (classes, bits)) for seed in range(64)]
    apart = lambda code: np.sort((code[:, None] != code[None]).sum(-1).ravel())[classes]
    return max((c for c in made if (abs(c.sum(0)) < classes).all()), key=apart, default=made[0])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams around each letter, their row, and whether each row has a letter; other characters are blanks."""
    lowered = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) + 2 for t in lowered])
    points = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(_letters()[points], points, 0).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(points)
    mixed = points[at - 1] * np.uint64(0x9E3779B97F4A7C15) + points[at] * np.uint64(0xC2B2AE3D27D4EB4F) + points[at + 1] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), row[at], np.bincount(row[at], minlength=len(texts)) > 0


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weight: np.ndarray  # buckets x bits, log odds
    trust: np.ndarray  # bits

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1) and ambiguity of each text."""
        hashed, row, lettered = _trigrams(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        margin = np.zeros((len(texts), self.code.shape[1]))
        found, first, count = np.unique(row, return_index=True, return_counts=True)
        for bit in range(self.code.shape[1]) if len(found) else ():
            total = np.add.reduceat(self.weight[bit][hashed], first)
            margin[found, bit] = total / count * np.minimum(count, EVIDENCE)
        loss = np.stack([(np.logaddexp(0, -word * margin) * self.trust).sum(1) for word in self.code], 1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = loss.argmin(1)
        score = np.where(lettered, share[np.arange(len(texts)), best], 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], score, ~lettered | (score < CLEAR)


def _counts(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all labelled rows; every task sums what it reads before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for step in steps(batch, "text"):
                langs = np.array(step.column(1).to_pylist(), dtype=object)
                hashed, row, _ = _trigrams(step.column(0).to_pylist())
                names, which = np.unique(langs.astype(str), return_inverse=True)
                for i, name in enumerate(names):
                    n = np.bincount(hashed[which[row] == i], minlength=BUCKETS)
                    sums[name] = sums[name] + n if name in sums else n
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"]
            )

    made = labelled.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long")
    return made.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame) -> Model:
    """A model from all rows with text and lang; it holds at most languages x BUCKETS counts, whatever the corpus."""
    bound_batches(labelled.sparkSession)
    rows = _counts(labelled.where("text is not null and lang is not null")).toArrow()
    languages = sorted(set(rows["lang"].to_pylist()))
    place = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    counts[np.array([place[x] for x in rows["lang"].to_pylist()], dtype=np.int64), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    rate = (counts + 0.1) / (counts.sum(1, keepdims=True) + 0.1 * BUCKETS)
    code = codewords(len(languages))
    bits = code.shape[1]
    weight, trust = np.zeros((bits, BUCKETS), dtype=np.float32), np.ones(bits)
    for bit in range(bits if len(languages) > 1 else 0):
        side = code[:, bit] > 0
        weight[bit] = np.log(rate[side].mean(0)) - np.log(rate[~side].mean(0))
        # The least expected margin of a language on its own side.
        trust[bit] = max(0.05, float((rate @ weight[bit] * code[:, bit]).min()))
    return Model(languages, code, weight, trust / trust.mean())


def identify(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous, from the text alone.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be learned.
    Every row gets its own result, whatever its other columns hold. ``columns`` names those to keep (default: all);
    columns with the names of the results are replaced.
    """
    columns = [c for c in columns or docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bound_batches(docs.sparkSession)
    kept = docs.select(*columns, *([] if "text" in columns else ["text"]))
    n, at = len(columns), kept.columns.index("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                lang, score, unclear = shared.value.predict(step.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*step.columns[:n], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unclear)],
                    names=[*columns, "lang_pred", "score", "ambiguous"],
                )

    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id="doc_id"):
    """True for the documents that are kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
