"""Quality rules: n-gram perplexity under a modified Kneser-Ney model that Spark counts over the whole corpus.

Symbols are lower-cased characters (12-bit classes: exact below U+1000, folded beyond), n-grams have ORDER of them and
belong to the text's language. Tasks count what they read, Spark sums the counts, derives continuation counts,
discounts and interpolated probabilities by joins. Tasks are sent the most frequent entries as sorted arrays, all of
them in most corpora; what a task doesn't find in a model that is not whole, Spark looks up by joins, so every text gets
its exact value. A language's documents are rejected where their log-perplexity lies below or above its band, the quartiles widened by LOW_FENCE and
HIGH_FENCE times their distance; for short texts the deviation counts in proportion to what they tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import stored
from pagemill.llm.textops import NOT_SPACE, Words, buffers, mix, prefix, shingles, span_hashes, spans, steps

ORDER = 4
SYMBOL_BITS = 12
#: Entries that tasks hold in memory, 12 bytes each; Spark joins the rarer ones.
MODEL_ENTRIES = 1 << 23
#: Bands reach so many quartile distances below the first and above the third quartile.
LOW_FENCE = 2.0
HIGH_FENCE = 2.0
#: A text of so many symbols deviates by half of what its perplexity says.
HALF_TOLD = 100
UNKNOWN = "und"
_SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol n-grams of ORDER that end at each character, and their row."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    pad = " " * (ORDER - 1)
    points = np.frombuffer("".join(pad + t for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(points < 1 << SYMBOL_BITS, points, points % np.uint32(4093)).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(sizes.sum()) + (ORDER - 1) * (row + 1)
    grams = points[at]
    for back in range(1, ORDER):
        grams = grams | points[at - back] << (SYMBOL_BITS * back)
    return grams, row


def _lowered(column: pa.Array) -> list[str]:
    return [(t or "").lower() for t in column.to_pylist()]


def ngram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of all documents; a null lang is counted as a language of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for step in steps(batch, "text"):
                grams, row = _symbols(_lowered(step.column(0)))
                names, which = np.unique(np.array(step.column(1).to_pylist(), dtype=str), return_inverse=True)
                for i, name in enumerate(names):
                    keys, n = np.unique(grams[which[row] == i] if len(names) > 1 else grams, return_counts=True)
                    if name in sums:
                        both, at = np.unique(np.concatenate([sums[name][0], keys]), return_inverse=True)
                        n = np.bincount(at, np.concatenate([sums[name][1], n]), len(both)).astype(np.int64)
                        keys = both
                    sums[name] = keys, n
        for name, (keys, n) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]).take(pa.array(np.zeros(len(keys), np.int64))), pa.array(keys), pa.array(n)], names=["lang", "gram", "n"]
            )

    read = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    made = read.mapInArrow(run, "lang string, gram long, n long")
    return made.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounted(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """(lang, gram, context, n, part): discounted relative counts; (lang, context, whole, spare): the mass left to lower
    orders."""
    of = lambda k: F.sum((F.col("n") == k).cast("long"))
    met = counts.groupBy("lang").agg(*[of(k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.try_divide(F.col("n1").cast("double"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        exact = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}").cast("double"), F.col(f"n{k}"))
        # A corpus too small for the estimate takes a fixed share.
        return F.greatest(F.lit(0.1), F.least(F.lit(k - 0.1), F.coalesce(exact, F.lit(0.5 * k))))

    met = met.select("lang", *[F.coalesce(discount(k), F.lit(0.5 * k)).alias(f"d{k}") for k in (1, 2, 3)])
    counts = counts.join(met, "lang").withColumn("context", F.shiftright("gram", SYMBOL_BITS))
    off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    counts = counts.withColumn("off", F.least(off, F.col("n").cast("double")))
    context = counts.groupBy("lang", "context").agg(F.sum("n").alias("whole"), F.sum("off").alias("off"))
    parts = counts.select("lang", "gram", "context", "n", (F.col("n") - F.col("off")).alias("left")).join(
        context.select("lang", "context", "whole"), ["lang", "context"]
    ).select("lang", "gram", "context", "n", (F.col("left") / F.col("whole")).alias("part"))
    return parts, context.select("lang", "context", "whole", (F.col("off") / F.col("whole")).alias("spare"))


def model_table(docs: DataFrame) -> DataFrame:
    """(kind, lang, gram, value, n): log probabilities of n-grams (kind 1..ORDER), log of the spare mass of contexts
    (kind 10 + order), and the log probability of an unknown symbol (kind 0); n says how often each was met."""
    counts = [stored(ngram_counts(docs))]
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << SYMBOL_BITS * order) - 1)
        counts.insert(0, counts[0].select("lang", suffix.alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n")))
    size = counts[0].groupBy("lang").agg((1.0 / (F.count("*") + 1)).alias("p"))
    out = [size.select(F.lit(0).alias("kind"), "lang", F.lit(0).cast("long").alias("gram"), F.log("p").alias("value"), F.lit((1 << 63) - 1).alias("n"))]
    lower = None
    for order in range(1, ORDER + 1):
        parts, spare = _discounted(counts[order - 1], order)
        parts = parts.join(spare, ["lang", "context"])
        if lower is None:
            parts = parts.join(size, "lang")
        else:
            suffix = F.col("gram").bitwiseAND((1 << SYMBOL_BITS * (order - 1)) - 1)
            parts = parts.withColumn("suffix", suffix).join(lower, ["lang", "suffix"])
        lower = stored(parts.select("lang", F.col("gram").alias("suffix"), "n", (F.col("part") + F.col("spare") * F.col("p")).alias("p")))
        out.append(lower.select(F.lit(order).alias("kind"), "lang", F.col("suffix").alias("gram"), F.log("p").alias("value"), "n"))
        out.append(spare.select(F.lit(10 + order).alias("kind"), "lang", F.col("context").alias("gram"), F.log("spare").alias("value"), F.col("whole").alias("n")))
        lower = lower.drop("n")
    made = out[0]
    for one in out[1:]:
        made = made.union(one)
    return made


class Model:
    """Sorted arrays of n-grams and their values by language and kind; ``rest`` is the table of all entries where these
    are not all of them, else None."""

    def __init__(self, held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]], rest: DataFrame | None = None):
        self.held, self.rest = held, rest

    def find(self, lang: str, kind: int, grams: np.ndarray) -> np.ndarray:
        """The values of n-grams, NaN where there is none."""
        keys, values = self.held.get((lang, kind), ((), ()))
        if not len(keys):
            return np.full(len(grams), np.nan, dtype=np.float32)
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        return np.where(keys[at] == grams, values[at], np.float32(np.nan))

    def log_probabilities(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each n-gram: its own, or the spare mass times the next lower order's."""
        out = self.find(lang, ORDER, grams)
        left = np.flatnonzero(np.isnan(out))
        out[left] = 0
        for order in range(ORDER, 0, -1):
            if not len(left):
                return out
            low = grams[left] & ((1 << SYMBOL_BITS * order) - 1)
            if order < ORDER:
                p = self.find(lang, order, low)
                known = ~np.isnan(p)
                out[left[known]] += p[known]
                left, low = left[~known], low[~known]
            spare = self.find(lang, 10 + order, low >> SYMBOL_BITS)
            out[left] += np.where(np.isnan(spare), 0, spare)
        if len(left):
            zero = self.find(lang, 0, np.zeros(1, np.int64))[0]
            out[left] += zero if not np.isnan(zero) else np.float32(-np.log(1 << SYMBOL_BITS))
        return out


def _least_count(entries: DataFrame, limit: int) -> int:
    """The least power of two so that at most ``limit`` entries were met so often."""
    above, least = 0, 1 << 62
    for row in entries.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).collect():
        above += row["count"]
        if above > limit:
            return least
        least = 1 << min(row.power, 62)
    return 1


def build_model(docs: DataFrame, limit: int = MODEL_ENTRIES) -> Model:
    """The model of all documents. At most ``limit`` entries, the most frequent ones, reach the driver and the tasks."""
    made = stored(model_table(docs))
    least = _least_count(made, limit)
    entries = made.where(F.col("n") >= least).select("kind", "lang", "gram", F.col("value").cast("float")).toArrow()
    kind, gram, value = (entries[c].to_numpy() for c in ("kind", "gram", "value"))
    coded = entries["lang"].combine_chunks().dictionary_encode()
    lang = coded.indices.to_numpy()
    order = np.lexsort((gram, kind, lang))
    kind, lang, gram, value = kind[order], lang[order], gram[order], value[order]
    cut = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | (lang[1:] != lang[:-1]))[: len(kind)])
    names = coded.dictionary.to_pylist()
    held = {(names[lang[a]], int(kind[a])): (gram[a:b], value[a:b]) for a, b in zip(cut, np.append(cut[1:], len(kind)))}
    return Model(held, made if least > 1 else None)


def looked_up(missed: DataFrame, table: DataFrame) -> DataFrame:
    """(lang, gram, value): log probabilities of distinct n-grams from the whole table, by joins: as Model.log_probabilities."""
    wanted = missed.select("lang", "gram").distinct()
    found, added = F.lit(None).cast("double"), F.lit(0.0)
    for order in range(ORDER, 0, -1):
        low = F.col("gram").bitwiseAND((1 << SYMBOL_BITS * order) - 1)
        own = table.where(F.col("kind") == order).select("lang", F.col("gram").alias(f"_low{order}"), F.col("value").alias(f"_own{order}"))
        spare = table.where(F.col("kind") == 10 + order).select("lang", F.col("gram").alias(f"_context{order}"), F.col("value").alias(f"_spare{order}"))
        wanted = wanted.withColumns({f"_low{order}": low, f"_context{order}": F.shiftright(low, SYMBOL_BITS)})
        wanted = wanted.join(own, ["lang", f"_low{order}"], "left").join(spare, ["lang", f"_context{order}"], "left")
        found = F.coalesce(found, added + F.col(f"_own{order}"))
        added = added + F.coalesce(f"_spare{order}", F.lit(0.0))
    zero = table.where("kind = 0").select("lang", F.col("value").alias("_zero"))
    unknown = F.coalesce("_zero", F.lit(float(-np.log(1 << SYMBOL_BITS))))
    return wanted.join(zero, "lang", "left").select("lang", "gram", F.coalesce(found, added + unknown).alias("value"))


def _repeats(own: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which items equal an earlier one of the same row, and which have an equal one at all."""
    key = mix(hashes + mix(own.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later, any_ = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = any_[order[:-1][same]] = True
    return later, any_


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """The base rules' counts of each text."""
    data, offsets = buffers(column)
    n = len(offsets) - 1
    words = Words(data, offsets, NOT_SPACE, lower=False)
    row_of = lambda at: np.searchsorted(offsets, at, side="right") - 1
    inside = NOT_SPACE[data] & (data & 0xC0 != 0x80)
    running = np.concatenate([[0], np.cumsum(inside)])
    symbols = np.concatenate([[0], np.cumsum(np.isin(data, _SYMBOLS))])
    not_newline = np.ones(256, dtype=bool)
    not_newline[10] = False
    start, stop = spans(data, offsets, not_newline)
    worded = running[stop] > running[start]
    start, stop = start[worded], stop[worded]
    sums = prefix(data)
    again, _ = _repeats(row_of(start), span_hashes(sums, start, stop))
    windows, bounds = shingles(span_hashes(sums, words.start, words.stop), words.first, 8)
    made = np.diff(bounds)
    own = np.repeat(np.arange(n), made)
    _, twice = _repeats(own, windows)
    low = (words.first[:-1][own] + np.arange(len(own)) - bounds[:-1][own])[twice]
    cover = np.zeros(len(words.start) + 9, dtype=np.int64)
    np.add.at(cover, low, 1)
    np.add.at(cover, low + 8, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[: len(words.start)] > 0)])
    return {
        "n_words": words.counts, "word_chars": running[offsets[1:]] - running[offsets[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.bincount(row_of(start)[again], minlength=n),
        "n_repeat_words": covered[words.first[1:]] - covered[words.first[:-1]],
    }


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, the base counts, n_chars_scored and log_perplexity (null for an empty text) of every document."""
    shared, rest = docs.sparkSession.sparkContext.broadcast(Model(model.held)), model.rest
    partly = rest is not None
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                base = measures(step.column(2))
                grams, row = _symbols(_lowered(step.column(2)))
                langs = np.array(step.column(1).to_pylist(), dtype=str)
                p = np.zeros(len(grams), dtype=np.float64)
                for name in np.unique(langs):
                    own = (langs == name)[row]
                    known = shared.value
                    p[own] = known.find(str(name), ORDER, grams[own]) if partly else known.log_probabilities(str(name), grams[own])
                left = np.isnan(p)
                p[left] = 0
                ends = np.append(0, np.cumsum(np.bincount(row[left], minlength=step.num_rows)))
                n = np.bincount(row, minlength=step.num_rows)
                total = np.bincount(row, p, step.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), step.column(1), *[pa.array(base[k].astype(np.int64)) for k in names], pa.array(n),
                     pa.array(total, mask=n == 0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams[left]))],
                    names=["doc_id", "lang", *names, "n_scored", "total", "missed"],
                )

    read = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    fields = ", ".join(f"{k} long" for k in names)
    made = read.mapInArrow(run, f"doc_id long, lang string, {fields}, n_scored long, total double, missed array<long>")
    if partly:
        made = stored(made.withColumn("_row", F.monotonically_increasing_id()))
        missed = made.select("_row", "lang", F.explode("missed").alias("gram")).groupBy("_row", "lang", "gram").agg(F.count("*").alias("n"))
        missed = stored(missed)
        more = missed.join(looked_up(missed, rest), ["lang", "gram"]).groupBy("_row").agg(F.sum(F.col("n") * F.col("value")).alias("more"))
        made = made.join(more, "_row", "left").withColumn("total", F.col("total") + F.coalesce("more", F.lit(0.0)))
    return made.select("doc_id", "lang", *names, "n_scored", (-F.col("total") / F.greatest("n_scored", F.lit(1))).alias("log_perplexity"))


def judge(docs: DataFrame, low: float = LOW_FENCE, high: float = HIGH_FENCE, limit: int = MODEL_ENTRIES) -> DataFrame:
    """One row per document: doc_id, lang, the base counts, base_failed, log_perplexity, the band and kept.

    A null text is an empty text: no words, so base_failed. A null lang is the language ``und``. Repeated rows are
    judged alike, other columns are ignored, an empty table gives an empty result.
    """
    found = stored(scores(docs, build_model(docs, limit)))
    quarter = F.percentile_approx("log_perplexity", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10_000))
    bands = found.where("log_perplexity is not null").groupBy("lang").agg(quarter.alias("q")).select(
        "lang", F.col("q")[1].alias("middle"),
        (F.col("q")[0] - low * (F.col("q")[2] - F.col("q")[0])).alias("low"),
        (F.col("q")[2] + high * (F.col("q")[2] - F.col("q")[0])).alias("high"),
    )
    told = F.col("n_scored") / (F.col("n_scored") + HALF_TOLD)
    level = F.col("middle") + (F.col("log_perplexity") - F.col("middle")) * told
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    joined = found.join(bands, "lang", "left").withColumn("base_failed", failed)
    return joined.withColumn("kept", ~failed & F.coalesce(level.between(F.col("low"), F.col("high")), F.lit(False)))
