"""Page blocks of binary documents. The PDF library is an optional extra."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Content types of documents.
DOCUMENT_TYPES = (
    "application/pdf", "application/msword", "application/vnd.openxmlformats-officedocument", "application/vnd.ms-",
)
BLOCKS = T.StructType(
    [
        T.StructField("path", T.StringType()), T.StructField("page", T.IntegerType()),
        T.StructField("text", T.StringType()), T.StructField("skipped", T.StringType()),
    ]
)


def is_document_type(content_type: Column) -> Column:
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    hit = F.lit(False)
    for prefix in DOCUMENT_TYPES:
        hit = hit | kind.startswith(prefix)
    return hit


def is_html_type(content_type: Column) -> Column:
    """True for HTML types and for an unknown type."""
    return F.coalesce(F.lower(content_type).contains("html"), F.lit(True))


def _pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    try:
        from pypdf import PdfReader
    except ImportError:
        PdfReader = None
    for batch in batches:
        rows = []
        for path, content in zip(batch["path"], batch["content"]):
            if PdfReader is None:
                rows.append((path, None, None, "parser_not_installed"))
                continue
            for number, page in enumerate(PdfReader(io.BytesIO(content)).pages, 1):
                text = (page.extract_text() or "").strip()
                if text:
                    rows.append((path, number, text, None))
        yield pd.DataFrame(rows, columns=BLOCKS.names)


def document_pages(files: DataFrame) -> DataFrame:
    """One row per non-empty page of ``files(path, content)``; a reason where no parser is installed."""
    return files.select("path", "content").mapInPandas(_pages, BLOCKS)


def document_text(blocks: DataFrame) -> DataFrame:
    """Pages joined with blank lines; a document is one row, as its file was."""
    rows = blocks.filter(F.col("text").isNotNull()).groupBy("path").agg(F.collect_list(F.struct("page", "text")).alias("p"))
    texts = F.transform(F.array_sort("p"), lambda x: x["text"])
    return rows.select("path", F.array_join(texts, "\n\n").alias("plain_text"), F.size("p").alias("page_count"))
