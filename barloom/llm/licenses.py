"""License texts and mentions, by votes on diagonals; column expressions only.

1. All rolling ``K``-word hashes of a document are joined with those of the templates.
   A match at word ``p`` of the document and ``t`` of the template votes for the
   diagonal ``p - t``. Votes are added up before they are exchanged.
2. Neighbouring diagonals of a template are merged, so that a copy with a few words
   put in or left out still counts as one.
3. What has enough votes is cut out of the document and compared word by word; words of
   a template that tell it from others (``TELLING``) must be there.
4. Of templates whose spans overlap, the one with most matched words stays.

Templates are a fixed table of a few hundred words, so broadcasting it is bounded.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import KEY, broadcast_if_small, keyed, lower_ascii, sliding, stored, with_once, words_of

K = 3
GAP = 2  # diagonals this near belong together
LEAST_COVERAGE = 0.8
# Versions differ in one word, so a template shorter than this needs all its words.
SHORT = 15
# Whatever the share, a template with one of these words needs it.
TELLING = ["apache", "mozilla", "lesser", "library", "affero", "2", "3", "4"]

# Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Sentences of well-known public licenses.
TEXTS = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the Software), to deal in the Software without restriction", "mit"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at"
     " http://www.apache.org/licenses/LICENSE-2.0", "apache-2"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
     " the following conditions are met", "bsd"),
    ("licensed under the GNU General Public License, version 3", "gpl-3"),
    ("licensed under the GNU General Public License, version 2", "gpl-2"),
    ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
     " the Free Software Foundation", "gpl"),
    ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published"
     " by the Free Software Foundation", "lgpl"),
    ("you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published"
     " by the Free Software Foundation", "lgpl"),
    ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published"
     " by the Free Software Foundation", "agpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
     " granted", "isc"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "cc-by-nd"),
    ("licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "cc-by-nc-sa"),
    ("licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "cc-by-nc-nd"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
]


def templates(spark: SparkSession, phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """template, label, exact, words; each template has ``K`` words at least."""

    def split(text: str) -> list[str]:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    rows = [(label, True, split(t)) for t, label in phrases] + [(label, False, split(t)) for t, label in texts]
    if any(len(words) < K for *_, words in rows):
        raise ValueError(f"a template needs {K} words")
    rows = [(n, *row) for n, row in enumerate(rows)]
    return spark.createDataFrame(rows, "template int, label string, exact boolean, words array<string>")


def _grams(df: DataFrame) -> DataFrame:
    """(other columns, pos, gram): one row per rolling hash; ``pos`` is null where there is none."""
    rest = [c for c in df.columns if c != "words"]
    n = F.greatest(F.size("words") - (K - 1), F.lit(0))
    hashed = with_once(df, _gram=F.transform("words", lambda w: F.xxhash64(w))).select(*rest, n.alias("_n"), "_gram")
    hashed = sliding(hashed, "_gram", K, lambda a, b: F.xxhash64(a, b))
    return hashed.select(*rest, F.posexplode_outer(F.slice("_gram", 1, F.col("_n")))).withColumnRenamed("col", "gram")


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, spans). Rows: doc_id, key, n_words, copies for each distinct row. Spans: key,
    template, label, exact, ``first_word``, ``last_word``, ``coverage`` for each verified span.

    Null and empty texts have no words and no span. An exact template needs all its words
    in a row; of any other, the share ``LEAST_COVERAGE`` on one diagonal or its
    neighbours, and its ``TELLING`` words. Of these others no two spans of a document
    overlap. Repeated rows are scanned as one and counted in ``copies``.
    """
    spark = documents.sparkSession
    known = templates(spark) if known is None else known
    docs = keyed(documents, doc_id, text)

    def with_words(df: DataFrame) -> DataFrame:
        return with_once(df, words=words_of(lower_ascii(F.col("body"))))

    table = F.broadcast(
        _grams(known.select("template", "exact", F.size("words").alias("size"), "words")).withColumnRenamed("pos", "t")
    )
    base = with_words(docs).select("doc_id", *KEY, F.size("words").cast("bigint").alias("n_words"), "words")
    found = _grams(base).join(table, "gram", "left")
    # The first place of each row stays as well, to count rows and carry the number of words.
    first = F.coalesce("pos", F.lit(0)) == 0
    votes = stored(
        found.where(first | F.col("template").isNotNull())
        .groupBy("doc_id", *KEY, "n_words", "template", "exact", "size", (F.col("pos") - F.col("t")).alias("diagonal"))
        .agg(F.count_distinct("pos").alias("votes"), F.count_if(first).alias("firsts"))
    )
    # A first place with several matches stands under several diagonals, each time once per repeated row.
    rows = votes.groupBy("doc_id", *KEY, "n_words").agg(F.max("firsts").alias("copies"))
    votes = votes.where("template is not null")
    order = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    new = F.col("exact") | (F.col("diagonal") - F.lag("diagonal", 1, -(10**9)).over(order) > GAP)
    merged = (
        votes.withColumn("run", F.sum(new.cast("int")).over(order))
        .groupBy(*KEY, "template", "exact", "size", "run")
        .agg(F.sum("votes").alias("votes"), F.sort_array(F.collect_set("diagonal")).alias("diagonals"))
    )
    # Each missing word costs K grams at most, so true spans always reach the verification.
    lost = F.when(F.col("size") < SHORT, 0).otherwise(F.floor(F.col("size") * (1 - LEAST_COVERAGE)) * K)
    enough = F.col("votes") >= F.when(F.col("exact"), F.col("size") - (K - 1)).otherwise(
        F.greatest(F.lit(1), F.col("size") - (K - 1) - lost)
    )
    candidates = stored(
        merged.where(enough).select(
            *KEY, "template", "diagonals",
            F.greatest(F.array_min("diagonals"), F.lit(0)).alias("low"),
            (F.array_max("diagonals") + F.col("size")).alias("high"),
        ).distinct().groupBy(*KEY).agg(F.collect_list(F.struct("template", "diagonals", "low", "high")).alias("candidates"))
    )
    cut = F.transform(
        "candidates",
        lambda c: c.withField("part", F.slice("words", c["low"] + 1, F.greatest(c["high"] - c["low"], F.lit(0)))),
    )
    parts = with_words(docs.dropDuplicates(KEY).join(broadcast_if_small(candidates, candidates.count()), KEY)).select(*KEY, F.inline(cut))
    parts = with_once(parts.join(F.broadcast(known), "template"), hits=_hits())
    share = F.size("hits") / F.size("words")
    least = F.when(F.col("exact") | (F.size("words") < SHORT), 1.0).otherwise(LEAST_COVERAGE)
    telling = F.array_intersect("words", F.array(*map(F.lit, TELLING)))
    matched = F.transform("hits", lambda p: F.get("part", p - F.col("low")))
    verified = stored(parts.where((share >= least) & (F.size(F.array_except(telling, matched)) == 0)).select(
        *KEY, "template", "label", "exact",
        F.array_min("hits").cast("bigint").alias("first_word"),
        F.array_max("hits").cast("bigint").alias("last_word"),
        share.alias("coverage"),
        F.size("hits").alias("matched"),
    ))
    names = ["template", "label", "exact", "first_word", "last_word", "coverage"]
    # Best first: most matched words, then fewest missing ones, then fewest others between them.
    ranked = F.struct((-F.col("matched")).alias("m"), (-F.col("coverage")).alias("c"), (F.col("last_word") - F.col("first_word")).alias("w"), *names)
    by_doc = verified.where("not exact").groupBy(*KEY).agg(F.sort_array(F.collect_list(ranked)).alias("ranked"))
    none = F.slice("ranked", 1, 0)

    def better_first(kept: Column, s: Column) -> Column:
        overlaps = F.exists(kept, lambda k: (k["first_word"] <= s["last_word"]) & (s["first_word"] <= k["last_word"]))
        return F.when(overlaps, kept).otherwise(F.concat(kept, F.array(s)))

    best = by_doc.select(*KEY, F.inline(F.aggregate("ranked", none, better_first))).select(*KEY, *names)
    spans = verified.where("exact").select(*KEY, *names).union(best)
    return rows, spans


def _hits() -> Column:
    """Places in the document of the template's words that stand on one of the diagonals."""

    def place(t: Column) -> Column:
        word = F.get("words", t)
        same = F.filter("diagonals", lambda d: F.get("part", t + d - F.col("low")) == word)
        return t + F.array_min(same)

    return F.array_compact(F.transform(F.sequence(F.lit(0), F.size("words") - 1), place))


def label(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """One row per row: doc_id, n_words, places of exact templates, labels of these and of all, ``score``.

    ``score`` is the best coverage of a template, 1 for an exact one, 0 without any.
    """
    rows, spans = scan(documents, doc_id, text, known)
    start = F.when(F.col("exact"), F.col("first_word"))
    by_doc = spans.groupBy(*KEY).agg(
        F.count(start).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base"),
        F.sort_array(F.collect_set("label")).alias("all"),
        F.max("coverage").alias("score"),
    )
    joined = rows.join(by_doc, KEY, "left").select("*", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", "all").alias("labels"),
        F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return label(spark.read.parquet(f"{sf_dir}/documents.parquet"))
