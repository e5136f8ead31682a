"""Mentions of tracked projects in text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nulls import empty_to_null
from tidemark.functions.terms import (
    has_case_oddities,
    is_plain_word,
    leading_words,
    term_pattern,
    word_counts,
)
from tidemark.sources.dimensions import Project

CONTENT_COLUMNS = (
    "content_type",
    "created_utc",
    "created_date",
    "title",
    "id",
    "subreddit",
    "text",
    "permalink",
    "score",
)


def project_submissions(submissions: DataFrame) -> DataFrame:
    return submissions.select(
        F.lit("submission").alias("content_type"),
        "created_utc",
        "created_date",
        "title",
        "id",
        F.col("subreddit_name_prefixed").alias("subreddit"),
        F.col("selftext").alias("text"),
        "permalink",
        "score",
    )


def project_comments(comments: DataFrame) -> DataFrame:
    return comments.select(
        F.lit("comment").alias("content_type"),
        "created_utc",
        "created_date",
        F.lit("").alias("title"),
        "id",
        F.col("subreddit_name_prefixed").alias("subreddit"),
        F.col("body").alias("text"),
        "permalink",
        "score",
    )


def union_content(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    return project_submissions(submissions).unionByName(project_comments(comments))


def find_mentions(
    df: DataFrame,
    projects: Sequence[Project],
    text: str = "text",
    output: str = "projects_mentions",
) -> DataFrame:
    """Add the list of (project, mentions) of a text, in dictionary order; NULL
    when nothing is mentioned or the text is NULL.

    A match can only begin at one of a few whole words per term. Each text is
    cut into words once, and those that some term can begin with are counted.
    For a term of one word that is the result; the regular expression of any
    other runs only on texts that hold one of its words. Terms without such
    words, and texts with letters that fold to ASCII in unusual ways, always
    run the expressions, so counts are exact.
    """
    leads = {term: leading_words(term) for p in projects for term in p.terms}
    lead_words = sorted({w for words in leads.values() for w in words or ()})
    unguarded = any(words is None for words in leads.values())

    found = word_counts(F.col(text), lead_words) if lead_words else F.create_map()
    prepared = df.withColumn("_leads", found).withColumn("_odd", has_case_oddities(F.col(text)))

    # One SQL text for all counts: a dictionary has hundreds of terms, and
    # every call for a column is a round trip to the JVM.
    def count(term: str) -> str:
        by_pattern = f'regexp_count(`{text}`, r"{term_pattern(term)}")'
        words = leads[term]
        if words is None:
            return by_pattern
        if is_plain_word(term):
            held = f"coalesce(try_element_at(_leads, '{words[0]}'), 0)"
            return f"if(_odd, {by_pattern}, {held})"
        present = " OR ".join(f"map_contains_key(_leads, '{word}')" for word in words)
        return f"if(_odd OR {present}, {by_pattern}, 0)"

    counts = F.expr(f"array({', '.join(' + '.join(map(count, p.terms)) for p in projects)})")
    names = F.array(*[F.lit(p.name) for p in projects])
    every = F.zip_with(
        names, counts, lambda name, n: F.struct(name.alias("project"), n.alias("mentions"))
    )
    mentions = F.filter(every, lambda m: m["mentions"] > 0)
    if not unguarded:
        mentions = F.when(F.col("_odd") | (F.size("_leads") > 0), mentions)
    # _odd is NULL exactly when the text is.
    mentions = F.when(F.col("_odd").isNotNull(), mentions)
    # The list leaves through a generator of one row: a filter on it is not
    # pushed below, where it would count every term a second time.
    counted = prepared.withColumn("_mentions", mentions)
    kept = [c for c in df.columns if c != output]
    return counted.select(
        *kept, F.explode(F.array(empty_to_null(F.col("_mentions")))).alias(output)
    )


def mentioned_projects(mentions: Column) -> Column:
    """The distinct projects of a mention list."""
    return F.array_distinct(F.transform(mentions, lambda m: m["project"]))


def explode_mentions(df: DataFrame, mentions: str = "projects_mentions") -> DataFrame:
    """One row per content row and mentioned project; rows without any vanish."""
    others = [c for c in df.columns if c != mentions]
    return df.select(*others, F.inline(mentions))
