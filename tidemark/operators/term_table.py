"""Mentions by a dictionary that is a table of any size.

``find_mentions`` writes its terms into the plan, which suits hundreds. Here
they stay rows: the plan depends on how many words the longest term has, not
on how many terms there are.

A match takes up whole words of a text, and their letters and digits, put
together, are those of the term, whatever hyphens, spaces or punctuation lie
between. So the terms are a trie of what their first 1, 2, ... words come to, a
row for each node. Words of texts are held against it level by level, by an
equi-join on a hash: those that begin no term go at the first, and a further
word is added only where a longer term goes on. Terms that share their first
words share nodes, and cost a text nothing before it leaves the others. What
reaches the end of a term is a candidate, counted by the term's expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.functions.terms import NOT_WORD, WORD, folded, pattern_column

PROJECT, TERMS = "project_name", "project_search_terms"


def _written(df: DataFrame, label: str) -> DataFrame:
    spark, path = df.sparkSession, storage.scratch(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _text_words(text: Column) -> Column:
    return F.filter(F.split(text, NOT_WORD), lambda word: word != "")


def term_rows(projects: DataFrame, position: str | None = None) -> DataFrame:
    """(position, project, pattern, one_word, words, hash) of every term: its
    expression, whether it is one word and nothing else, the words that
    punctuation, hyphens and spaces leave, folded, and a hash of them all.
    ``position`` names the column that lists are ordered by, the name if None.
    A term without a letter or digit fails, as there is no word to find it by.
    """
    at = F.col(position).cast("long") if position else F.lit(0).cast("long")
    each = projects.select(
        at.alias("position"), F.col(PROJECT).alias("project"), F.explode(TERMS).alias("term")
    ).where(F.col("term").isNotNull())
    words = F.transform(_text_words(F.col("term")), folded)
    whole = F.when(F.size(words) > 0, words).otherwise(
        F.raise_error(F.concat(F.lit("search term without a word: "), "term"))
    )
    cut = each.select(
        "position",
        "project",
        pattern_column(F.col("term")).alias("pattern"),
        F.col("term").rlike(f"^{WORD}+\\z").alias("one_word"),
        whole.alias("words"),
    )
    return cut.withColumn("hash", F.xxhash64(F.array_join("words", "")))


def trie(terms: DataFrame) -> DataFrame:
    """(node, ends, more): hashes of what the terms' first words come to,
    whether a term ends there and whether one goes on."""
    upto = F.posexplode(
        F.transform("words", lambda _, i: F.xxhash64(F.array_join(F.slice("words", 1, i + 1), "")))
    ).alias("at", "node")
    each = terms.select(F.size("words").alias("n"), upto)
    last = F.col("at") == F.col("n") - 1
    return each.groupBy("node").agg(F.max(last).alias("ends"), F.max(~last).alias("more"))


def candidates(texts: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """(key, hash): which whole terms' words, by their hash, each text of
    (key, text) has as neighbours."""
    words = F.posexplode(_text_words(F.col("text"))).alias("at", "word")
    first = texts.select("key", words).select("key", "at", F.xxhash64(folded(F.col("word"))).alias("node"))
    started = first.join(nodes, "node").groupBy("key", "node", "ends", "more").agg(
        F.collect_set(F.when(F.col("more"), F.col("at"))).alias("starts")
    )
    started = _written(started, "term-starts")
    found = started.where("ends").select("key", F.col("node").alias("hash"))
    if longest > 1:
        # Only texts with a word that some longer term begins with.
        going = started.where("more").groupBy("key").agg(F.flatten(F.collect_list("starts")).alias("starts"))
        held = texts.join(going, "key").groupBy("key").agg(
            F.any_value("text").alias("text"), F.any_value("starts").alias("starts")
        )
        split = held.select("key", "starts", _text_words(F.col("text")).alias("words"))
        open_ = split.select("key", "words", F.explode("starts").alias("start")).select(
            "key", F.transform(F.slice("words", F.col("start") + 1, longest), folded).alias("words")
        ).distinct()
        for level in range(2, longest + 1):
            longer = open_.where(F.size("words") >= level).withColumn(
                "node", F.xxhash64(F.array_join(F.slice("words", 1, level), ""))
            )
            joined = _written(longer.join(nodes, "node"), "term-level")
            found = found.unionByName(joined.where("ends").select("key", F.col("node").alias("hash")))
            open_ = joined.where("more").select("key", "words")
    return found.distinct()


def _single_words(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, position, project, n) of terms of one word, which occur as often as
    words do that their expression matches. A text moves once, whole, and its
    words are counted where it is: a row for each word of each text would be
    several times as much. The expression runs on words with other letters than
    those of ASCII only, as the fold makes more equal than it does; words of
    ASCII letters with one fold are all alike to it."""
    each = texts.groupBy("key").agg(F.any_value("text").alias("text"))
    words = each.select("key", F.explode(_text_words(F.col("text"))).alias("word"))
    other = F.when(~_ascii("word"), F.col("word")).alias("other")
    counts = words.select("key", F.xxhash64(folded(F.col("word"))).alias("hash"), other).groupBy("key", "hash", "other").agg(
        F.count("*").alias("n")
    )
    plain = F.regexp_like(F.get("words", F.lit(0)), F.col("pattern")).alias("plain")
    held = terms.where("one_word").select("hash", "position", "project", "pattern", plain)
    same = F.when(F.col("other").isNull(), F.col("plain")).otherwise(F.regexp_like("other", F.col("pattern")))
    return counts.join(held, "hash").where(same).select("key", "position", "project", "n")


def _asked(texts: DataFrame, terms: DataFrame, longest: int) -> DataFrame:
    """(key, position, project, pattern): which terms' expressions have to run
    on which texts: those of several words, or of one with punctuation, where
    the words are neighbours."""
    longer = terms.where("NOT one_word")
    nodes = _written(trie(longer), "term-trie")
    found = candidates(texts, nodes, longest).join(longer, "hash")
    return _written(found.select("key", "position", "project", "pattern"), "term-candidates")


def _ascii(word: str) -> Column:
    return F.length(word) == F.octet_length(word)


def _lists(counted: DataFrame, n: str = "n") -> DataFrame:
    return counted.groupBy("key").agg(F.collect_list(F.struct("position", "project", n)).alias("found"))


def find_mentions_by_table(
    df: DataFrame,
    projects: DataFrame,
    text: str = "text",
    output: str = "projects_mentions",
    position: str | None = None,
) -> DataFrame:
    """Add the list of (project, mentions) of a text; NULL when nothing is
    mentioned or the text is NULL. ``projects`` is a table with the columns
    project_name and project_search_terms, lists are in the order of its column
    ``position`` and of names. Counts equal those of ``find_mentions``.

    Equal texts are matched once. An empty table of projects finds nothing;
    NULL terms and lists count nothing; a term that a project has twice counts
    twice. Letters are compared without case, character by character.
    """
    terms = _written(term_rows(projects, position), "terms")
    # 128 bits tell texts apart.
    key = F.unhex(F.substring(F.sha2(F.col(text), 256), 1, 32))
    texts = df.where(F.col(text).isNotNull()).select(key.alias("key"), F.col(text).alias("text"))
    counted = _single_words(texts, terms)
    longest = terms.where("NOT one_word").agg(F.max(F.size("words"))).first()[0] or 0
    if longest:
        asked = _asked(texts, terms, longest)
        # Only texts that an expression is asked of are brought together with it.
        with_text = texts.join(asked.select("key").distinct(), "key", "left_semi").groupBy("key").agg(
            F.any_value("text").alias("text")
        )
        matched = asked.join(with_text, "key").withColumn("n", F.regexp_count("text", F.col("pattern")).cast("long"))
        both = _lists(counted).unionByName(_lists(matched.where("n > 0").select("key", "position", "project", "n")))
        counted = both.groupBy("key").agg(F.flatten(F.collect_list("found")).alias("found")).select("key", F.inline("found"))
    lists = _lists(
        counted.groupBy("key", "position", "project").agg(F.sum("n").cast("int").alias("mentions")), "mentions"
    ).withColumn("found", F.sort_array("found"))
    mentions = F.transform("found", lambda m: F.struct(m["project"].alias("project"), m["mentions"].alias("mentions")))
    kept = [F.col(f"`{c}`") for c in df.columns if c != output]
    # Texts that are NULL have nothing to be joined by, and stay where they are.
    some = df.where(F.col(text).isNotNull()).withColumn("__key", key)
    joined = some.join(lists.select(F.col("key").alias("__key"), mentions.alias("__found")), "__key", "left")
    out = joined.select(*kept, F.col("__found").alias(output))
    none = df.where(F.col(text).isNull())
    return out.unionByName(none.select(*kept, F.lit(None).cast(out.schema[output].dataType).alias(output)))
