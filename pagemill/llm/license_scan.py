"""License scan by diagonal voting, in DataFrame operations only.

Every rolling word k-gram of every document is hashed and joined to the positions of the same k-gram in license
templates. A document that holds a template has the hits of one run on one diagonal (document position minus template
position). Hits are summed by diagonal, neighbouring diagonals (words inserted or left out) are merged, and a merged
span is verified by the share of the template's k-grams that it has and by its length. The phrases of the base rule
are templates like any other; they count where a single diagonal has all of their k-grams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.arrays import let

K = 3
#: Diagonals that differ by at most so many words belong to one span.
NEIGHBOURS = 2
#: Share of a template's k-grams that a span must have.
SHARE = 0.7
#: A span is at most so many times as long as its template.
STRETCH = 1.5
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The phrases of the base rule and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Opening or core sentences of public license notices.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
}


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of ASCII digits and letters and of anything beyond ASCII."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _SEPARATORS), lambda w: w != "")


def grams(of: Column, k: int = K) -> Column:
    """The hash of k words from each word on; at the end, where fewer are left, of those."""
    return let(of, lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, *[F.get(ws, i + j) for j in range(1, k)])))


def template_table(spark: SparkSession, base: dict[str, str], notices: dict[str, str], k: int = K) -> DataFrame:
    """(gram, template, label, is_base, at, n_grams): the k-grams of the templates, a fixed and small list."""
    rows = [(p, label, True) for p, label in base.items()] + [(p, label, False) for p, label in notices.items()]
    made = spark.createDataFrame(rows, "template string, label string, is_base boolean").withColumn("words", words(F.col("template")))
    made = made.withColumn("n_grams", F.size("words") - (k - 1)).where("n_grams > 0")
    return made.select("template", "label", "is_base", "n_grams", F.posexplode(F.slice(grams(F.col("words"), k), 1, F.col("n_grams"))).alias("at", "gram"))


def scan(docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None, share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    n_base counts the places of base phrases, first_word and last_word are the smallest and largest of their start
    words (null without one). spans holds (template label, first word, stop word, share) of each verified span; labels
    are those of base places and spans, score the largest share. Null and empty texts have no words; a document is
    known by doc_id (nulls included) and text, repeated rows get the same result each. A phrase of fewer than k words
    can't be found. An empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices
    # The templates are given as code, so their number has a fixed bound and a broadcast is safe.
    templates = template_table(docs.sparkSession, base, notices)
    known = [r["gram"] for r in templates.select("gram").distinct().collect()]
    of = ["doc_id", "text_hash"]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def at_templates(ws: Column) -> Column:
        """The places whose gram some template has; the others never leave their row."""
        placed = F.transform(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.struct(
            i.alias("word"), F.xxhash64(*[F.get(ws, i + j) for j in range(K)]).alias("gram")
        ))
        own = F.when(F.size(ws) > 0, F.filter(placed, lambda p: p["gram"].isin(known)))
        return own

    hits = keyed.select(*of, F.explode(let(words(F.col("text")), at_templates)).alias("at")).select(*of, "at.word", "at.gram")
    hits = hits.join(F.broadcast(templates), "gram").withColumn("diagonal", F.col("word") - F.col("at"))
    # Sets, so that equal rows of one document count once; each is at most as long as its template.
    by_diagonal = hits.groupBy(*of, "template", "label", "is_base", "n_grams", "diagonal").agg(F.collect_set("at").alias("at"))

    # A template's diagonals in one document, however many: the window runs over them in order and keeps none.
    along = Window.partitionBy(*of, "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOURS, F.lit(True))
    whole = F.when(F.col("is_base") & (F.size("at") == F.col("n_grams")), F.col("diagonal"))
    merged = by_diagonal.withColumn("span", F.sum(far.cast("int")).over(along)).groupBy(*of, "template", "label", "n_grams", "span").agg(
        F.count(whole).alias("n_base"), F.min(whole).alias("first_word"), F.max(whole).alias("last_word"),
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("met"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("first"), (F.max(F.col("diagonal") + F.array_max("at")) + K).alias("stop"),
    ).withColumn("share", F.col("met") / F.col("n_grams"))
    verified = (F.col("share") >= share) & (F.col("stop") - F.col("first") <= STRETCH * (F.col("n_grams") + K - 1))
    found = merged.groupBy(*of).agg(
        F.sum("n_base").alias("n_base"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.collect_set(F.when(F.col("n_base") > 0, F.col("label"))).alias("base_labels"),
        F.sort_array(F.collect_list(F.when(verified, F.struct("first", "stop", "label", "share")))).alias("spans"),
        F.collect_set(F.when(verified, F.col("label"))).alias("span_labels"), F.max(F.when(verified, F.col("share"))).alias("score"),
    ).where("n_base > 0 or size(spans) > 0").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_base", "first_word", "last_word", "base_labels", "span_labels",
        F.when(F.size("spans") > 0, F.col("spans")).alias("spans"), F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.col("score")).alias("score"),
    )
    none = F.array().cast("array<string>")
    base_labels, span_labels = F.coalesce("base_labels", none), F.coalesce("span_labels", none)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    counted = keyed.select(*of, F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return counted.join(found, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.sort_array(base_labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_labels, span_labels)), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans",
    )
