"""License scans by diagonal voting, on DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 2
# Words that an edit may shift what follows; share of a template that must occur.
SLACK = 4
COVERAGE = 0.8

# Phrases that must stand as they are, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Other names, and opening passages of well-known licenses.
TEMPLATES = (
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd license", "bsd"),
    ("creative commons attribution", "cc-by"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "mit",
    ),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
        "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        "gpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "bsd",
    ),
)


def template_grams(
    spark: SparkSession, phrases: tuple = PHRASES, templates: tuple = TEMPLATES, k: int = K
) -> DataFrame:
    """(gram, template, label, exact, size, at): the hash of every run of ``k``
    words of a template. A table of constants, a few hundred rows."""
    rows = [
        (i, label, i < len(phrases), text)
        for i, (text, label) in enumerate((*phrases, *templates))
    ]
    table = spark.createDataFrame(rows, "template int, label string, exact boolean, text string")
    split = table.withColumn("words", F.split("text", " "))
    return split.select(
        "template",
        "label",
        "exact",
        (F.size("words") - (k - 1)).alias("size"),
        F.posexplode(_grams(F.col("words"), k)).alias("at", "gram"),
    )


def _grams(words: Column, k: int) -> Column:
    """A hash of each run of ``k`` words."""
    all_runs = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))
    return F.slice(all_runs, F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0)))


def spans(
    docs: DataFrame,
    names: tuple[str, ...] = ("doc_id",),
    phrases: tuple = PHRASES,
    templates: tuple = TEMPLATES,
    k: int = K,
    coverage: float = COVERAGE,
    slack: int = SLACK,
) -> DataFrame:
    """The named columns, ``n_words``, ``row`` and, for each place that holds a
    template, ``label``, ``exact``, ``first``, ``last`` (words from 0) and
    ``coverage``. A document without such a place has one row with NULLs.

    All runs of ``k`` words are joined to those of the templates. A template
    that stands in a text as it is has all its votes on one diagonal, the
    difference of the positions; insertions and omissions move the rest to a
    neighbouring one, so diagonals at most ``slack`` apart are merged. A span
    counts if the merged votes cover ``coverage`` of the template's runs, in an
    extent at most half as long again. Phrases have to be covered entirely, on
    one diagonal.
    """
    lowered = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.coalesce(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))
    rows = docs.select(*names, found.alias("words")).withColumn("row", F.monotonically_increasing_id())
    # A first entry that no template has, so that each document stays.
    entries = rows.select(
        *names,
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.posexplode(F.concat(F.array(F.lit(0).cast("long")), _grams(F.col("words"), k))).alias("pos", "gram"),
    )
    grams = template_grams(docs.sparkSession, phrases, templates, k)
    # Broadcast: as many rows as the constants above have words.
    hits = entries.join(F.broadcast(grams), "gram", "left").where((F.col("pos") == 0) | F.col("at").isNotNull())
    keys = [*names, "row", "n_words"]
    marked = hits.withColumn("real", F.col("at").isNotNull() & (F.col("pos") > 0))
    votes = (
        marked.withColumn("pos", F.col("pos") - 1)
        .groupBy(
            *keys,
            *[F.when(F.col("real"), F.col(c)).alias(c) for c in ("template", "label", "exact", "size")],
            F.when(F.col("real"), F.col("pos") - F.col("at")).alias("diagonal"),
        )
        .agg(F.count("*").alias("votes"), F.collect_set("at").alias("ats"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    )
    # Diagonals of phrases stay alone; others follow each other closely or not.
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    fresh = F.col("exact") | F.coalesce(
        (F.col("diagonal") - F.lag("diagonal").over(along) > slack)
        | (F.col("low") > F.lag("high").over(along) + F.col("size")),
        F.lit(True),
    )
    merged = (
        votes.withColumn("fresh", fresh.cast("int"))
        .withColumn("run", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "template", "label", "exact", "size", "run")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("covered"),
            F.min("low").alias("first"),
            (F.max("high") + (k - 1)).alias("last"),
        )
        .withColumn("coverage", F.col("covered") / F.col("size"))
    )
    holds = F.when(F.col("exact"), F.col("covered") == F.col("size")).otherwise(
        (F.col("coverage") >= coverage)
        & (2 * (F.col("last") - F.col("first") + 1) <= 3 * (F.col("size") + k - 1))
    )
    ok = F.coalesce(holds, F.lit(False))
    return merged.withColumn("ok", ok).where(ok | F.col("template").isNull()).select(
        *keys, *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("label", "exact", "first", "last", "coverage")]
    )


def licensed(docs: DataFrame, names: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """A row for each document: n_words, the exact places of the phrases
    (n_base, first_word, last_word, base_labels), all labels, and the best
    coverage as ``score`` (0 without any).

    Texts are lower-cased in A-Z alone. Words are runs of ASCII digits, ASCII
    letters and whatever is not ASCII. NULL and empty texts have no words and
    the empty string for labels. Equal rows are rows of their own.
    """
    places = spans(docs, names, **options)
    exact = F.coalesce("exact", F.lit(False))
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        places.groupBy(*names, "row", "n_words")
        .agg(
            F.sum(exact.cast("long")).alias("n_base"),
            F.min(F.when(exact, F.col("first"))).cast("long").alias("first_word"),
            F.max(F.when(exact, F.col("first"))).cast("long").alias("last_word"),
            labels(F.when(exact, F.col("label"))).alias("base_labels"),
            labels("label").alias("labels"),
            F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
