"""File sources. Every reader is lazy and splits large inputs over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.text import strip
from pagemill.operators.enrich import SPEC_SCHEMA


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines: byte-order mark dropped, blank lines skipped, a malformed line fails the job.

    With a schema the columns come typed; without one there is a single VARIANT ``payload``.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("line"))
    lines = lines.filter(strip(F.col("line")) != "")
    if schema is None:
        return lines.select(F.parse_json("line").alias("payload"))
    parsed = lines.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("row"))
    return parsed.select("row.*")


def read_json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON document per file."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return reader.schema(schema).json(path) if schema else reader.json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Input records as string maps, any keys."""
    lines = read_jsonl(spark, path)
    return lines.select(F.from_json(F.to_json("payload"), "map<string,string>").alias("record"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Field-group registry: JSON lines with the columns of ``SPEC_SCHEMA``."""
    return read_jsonl(spark, path, SPEC_SCHEMA)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Title dictionary, JSON lines ``{"key", "ord", "values": {...}}``."""
    return read_jsonl(spark, path, "key string, ord int, values map<string,string>")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Answers file: one JSON object ``{"{id}:{group}": text}`` as rows."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return whole.select(F.explode("m").alias("key", "response"))


def read_binary(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Binary documents: ``path, modificationTime, length, content``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
