"""Scores that are kept: a text is given to a scorer once.

The store is a table of one row per scorer version and content. The content is
the text and its distinct projects, in order, since a scorer sees both; its key
is their SHA-256. A new version of a scorer has a partition of its own, and a
text without any score keeps NULL, so that it is not scored again either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.mentions import mentioned_projects
from tidemark.operators.scoring import Scorer, score_mentions
from tidemark.operators.sinks import create_table
from tidemark.schemas import SCORES
from tidemark.sources.tables import read_partitions

_KEY = "_content_key"


def content_key(mentions: Column, text: Column) -> Column:
    """32 bytes that stand for a text and its projects. NULL text is an empty
    one, as it is for the scorer; NULL mentions give NULL."""
    content = F.to_json(F.struct(mentioned_projects(mentions).alias("projects"), F.coalesce(text, F.lit("")).alias("text")))
    return F.when(mentions.isNotNull(), F.unhex(F.sha2(content, 256)))


def fill_scores(
    df: DataFrame,
    scorer: Scorer,
    path: str,
    version: str,
    mentions: str = "projects_mentions",
    text: str = "text",
) -> None:
    """Score the contents of ``df`` that the store has no row for, and add them.

    Equal contents are combined in each task before the shuffle, so that a text
    with many copies is a row per task there. New rows appear when all of them
    are written: a failed run leaves none. One writer per store at a time.
    """
    spark = df.sparkSession
    create_table(spark, path, SCORES)
    contents = (
        df.where(F.col(mentions).isNotNull())
        .select(content_key(F.col(mentions), F.col(text)).alias(_KEY), F.col(mentions).alias("mentions"), F.col(text).alias("text"))
        .dropDuplicates([_KEY])
    )
    known = _stored(spark, path, version).select(_KEY)
    unknown = contents.join(known, _KEY, "left_anti")
    scored = score_mentions(unknown, scorer, "mentions", "text", "scores")
    new = scored.select(F.col(_KEY).alias("content_key"), "scores", F.lit(version).alias("version"))
    new.write.mode("append").partitionBy("version").parquet(path)


def stored_scores(
    df: DataFrame,
    path: str,
    version: str,
    mentions: str = "projects_mentions",
    text: str = "text",
    output: str = "projects_mentions_polarity",
) -> DataFrame:
    """Add the stored list of each row with mentions, NULL for rows without and
    for contents that were never scored.

    Rows without mentions take no part in the join, in which all would meet;
    adaptive execution splits the key of a text with many copies.
    """
    kept = [c for c in df.columns if c != output]
    keyed = df.select(*kept).withColumn(_KEY, content_key(F.col(mentions), F.col(text)))
    scores = _stored(df.sparkSession, path, version).withColumnRenamed("scores", output)
    found = keyed.where(F.col(_KEY).isNotNull()).join(scores, _KEY, "left").select(*kept, output)
    none = F.lit(None).cast(SCORES.schema["scores"].dataType)
    return found.unionByName(keyed.where(F.col(_KEY).isNull()).select(*kept, none.alias(output)))


def _stored(spark: SparkSession, path: str, version: str) -> DataFrame:
    rows = read_partitions(spark, path, SCORES, [version])
    return rows.select(F.col("content_key").alias(_KEY), "scores")
