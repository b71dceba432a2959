"""Queries of the operators over the driver tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import oracles
from pagemill.llm.bpe import encode
from pagemill.llm.common import table
from pagemill.llm.decontamination import contamination
from pagemill.llm.jaccard_join import jaccard_join
from pagemill.llm.language_id import held_out, identify, train
from pagemill.llm.license_scan import scan
from pagemill.llm.merkle_manifest import DOCUMENT, manifest, tampered_every_third
from pagemill.llm.paragraph_dedup import paragraph_clusters
from pagemill.llm.passages import repeated_passages
from pagemill.llm.perplexity import judge
from pagemill.llm.prefix_bpe import encode as prefix_encode
from pagemill.llm.quote_links import reply_ordered
from pagemill.llm.suffix_dedup import SIZE, cut, repeated_spans
from pagemill.llm.token_alignment import alignment
from pagemill.llm.token_files import round_trip

#: Names of tokenizer files; ``public_tokenizers`` knows their place on this machine and every executor.
TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows hit, and the items they are of."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=0)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op1_near_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of which every document holds a window with words put in, left out or moved by up to two places; exact
    matches are among them. A query of its own, as the SQL of ``op1_decontamination`` fixes that one's columns."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.size("near").cast("long").alias("n_near"),
        F.sha2(F.array_join("near", ","), 256).alias("near_sha256"),
    )


def op2_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, in its thread, with what it replies to."""
    return reply_ordered(table(spark, sf_dir, "conversations"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan(table(spark, sf_dir, "documents")).drop("spans")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum of ids, as read back from the token files."""
    found = round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base rules' counts of every document and whether it stays within its language's perplexity band."""
    found = judge(table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *base, "base_failed", "kept", "log_perplexity")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of 400-byte strings that start anywhere else too."""
    docs = table(spark, sf_dir, "documents")
    spans = repeated_spans(docs, SIZE, keep="none")
    left = cut(docs, spans).select("digest", F.sha2("kept", 256).alias("cut_sha256"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    whole = F.when(F.size("spans") == 0, F.lower(F.hex("digest"))).otherwise(F.sha2(F.lit("").cast("binary"), 256))
    return spans.join(left, "digest", "left").select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.coalesce("cut_sha256", whole).alias("kept_sha256"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document and the text they decode to, by length and digest."""
    found = encode(table(spark, sf_dir, "documents"), tokenizer_path(), ["doc_id"])
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    found = identify(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph (by ``line``) that stands in a run of repeated ones, with its cluster and its fate; and every later
    copy of a passage of 30 words and more, wherever it begins and ends (by ``first_word``; its ``line`` is null)."""
    docs = table(spark, sf_dir, "documents")
    lines = paragraph_clusters(docs).withColumn("first_word", F.lit(None).cast("int"))
    found = repeated_passages(docs).withColumns({"line": F.lit(None).cast("int"), "removed": F.lit(True)})
    return lines.unionByName(found).drop("text_hash")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, its set size and its component at a Jaccard similarity of 0.9 on 3-word shingles."""
    return jaccard_join(table(spark, sf_dir, "documents"), k=3, percent=90)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies meet in every document, and how common its pairs of ids are."""
    import public_tokenizers

    return alignment(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_LEVEL), tokenizer_path(PIECES), public_tokenizers.PATTERN)


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document and the bytes they decode to, by length and digest."""
    import public_tokenizers

    found = prefix_encode(table(spark, sf_dir, "documents"), tokenizer_path(RANKS), public_tokenizers.PATTERN, ["doc_id"])
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, its proof, and whether its leaf as found now still folds to the manifest's root."""
    return manifest(table(spark, sf_dir, "documents"), DOCUMENT, "lang", "doc_id", tampered_every_third())


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op1_near_matches": op1_near_matches,
    "op2_quote_links": op2_quote_links,
    "op3_license_scan": op3_license_scan,
    "op4_token_files": op4_token_files,
    "op5_perplexity": op5_perplexity,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_bpe": op7_bpe,
    "op8_language_id": op8_language_id,
    "op9_paragraph_dedup": op9_paragraph_dedup,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_token_alignment": op11_token_alignment,
    "op12_prefix_bpe": op12_prefix_bpe,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": oracles.DECONTAMINATION,
    "op2_quote_links": oracles.QUOTE_LINKS,
    "op3_license_scan": oracles.license_scan(),
    "op6_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op10_ngram_jaccard": oracles.NGRAM_JACCARD,
    "op13_merkle_manifest": oracles.MERKLE_MANIFEST,
}
