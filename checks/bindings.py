"""The driver's tables in the roles the library reads.

Each role is built by Spark over whole tables; :mod:`checks.sql` builds the
same rows in SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.operators.mentions import find_mentions
from tidemark.schemas import POLARITY_TYPE
from tidemark.sources.dimensions import Project

# Parameters of the queries.
REFERENCE = "2001-07-01"
EVENT_PROJECTS = "click,view,purchase"
EVENT_START, EVENT_END = "2024-01-05", "2024-01-20"
MENTION_REFERENCE = "2025-02-20"
CONTENT_START = date(2025, 1, 1)
CONTENT_EPOCH = 1_735_689_600  # its midnight, UTC
FETCHED = "2025-03-05"

PROJECTS = (
    Project("Alpha", ("that",), "Brand#1", ("Query Engine", " Data Storage")),
    Project("Beta", ("with", "with this"), "Brand#2", ("Query Engine",)),
    Project("Gamma", ("of the", "from"), "Brand#3", ("File Format", "Data Storage")),
    Project("Delta", ("Is",), "Brand#4", ("Query Engine", "File Format")),
    Project("Epsilon", ("the",), None, ("File Format",)),
    Project("Zeta", ("Evidence.dev",), "Brand#5", ("Data Storage",)),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_of(value: Column, *names: str | None) -> Column:
    """The name at a position, NULL past the end."""
    first, *rest = enumerate(names)
    case = F.when(value == first[0], F.lit(first[1]))
    for i, name in rest:
        case = case.when(value == i, F.lit(name))
    return case


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as nested download events."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("project"),
        F.struct(F.get_json_object("props", "$.k").alias("version")).alias("file"),
        F.struct(
            F.concat(F.lit("3."), (user % 5 + 8).cast("string")).alias("python"),
            F.struct(one_of(user % 4, "Linux", "Darwin", "Windows").alias("name")).alias("system"),
        ).alias("details"),
        one_of(user % 7, "US", "BR", "DE", "IN", "JP", "zz").alias("country_code"),
    )


def download_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` and its dimensions as downloads, one row per line. Rollups
    read these directly: a sum over days is a sum over lines, and summing up
    days first would shuffle once more."""
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    country = (
        F.when(F.col("c_nationkey") == 24, F.lit(None))
        .when(F.col("c_nationkey") == 23, F.lit("xx"))
        .otherwise(F.concat(_letter("c_nationkey"), _letter("n_regionkey")))
    )
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.to_date("o_orderdate").alias("download_date"),
            F.col("p_brand").alias("project"),
            F.col("p_type").alias("project_version"),
            F.col("l_linestatus").alias("python"),
            F.col("l_returnflag").alias("system_name"),
            country.alias("country_code"),
            F.col("l_quantity").cast("long").alias("download_count"),
        )
    )


def _letter(column: str) -> Column:
    return F.chr(F.lit(65) + F.col(column))


def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily downloads: one row per day and key."""
    rows = download_rows(spark, sf_dir)
    keys = [c for c in rows.columns if c != "download_count"]
    return rows.groupBy(*keys).agg(F.sum("download_count").alias("download_count"))


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as staged downloads with defects to audit: keys repeat,
    some values break a rule, some two."""
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("download_date"),
        F.col("l_suppkey").cast("string").alias("project"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber").cast("string")).alias(
            "project_version"
        ),
        F.col("l_linestatus").alias("python"),
        F.col("l_returnflag").alias("system_name"),
        one_of(F.col("l_suppkey") % 5, "US", "us", "BRA", "DE").alias("country_code"),
        (F.col("l_quantity") - 2).cast("int").alias("download_count"),
    )


def content_day(number: Column) -> Column:
    return F.date_add(F.lit(CONTENT_START), (number % 60).cast("int"))


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as submissions with ``conversations`` as comments."""
    return document_content(spark, sf_dir).unionByName(conversation_content(spark, sf_dir))


def document_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.lit("submission").alias("content_type"),
        F.col("doc_id").cast("string").alias("id"),
        content_day(F.col("doc_id")).alias("created_date"),
        "text",
    )


def conversation_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.lit("comment").alias("content_type"),
        (F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("id"),
        content_day(F.col("conv_id")).alias("created_date"),
        "text",
    )


def mentioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_mentions(content(spark, sf_dir), PROJECTS)


def polarity_of(text: Column, project: Column, mentions: Column) -> Column:
    """A test score: four decimals, and somewhat beyond [-1, 1], so that it
    falls in every band and every gap."""
    mixed = F.length(text) * 7919 + F.length(project) * 17 + mentions * 31
    return (mixed % 22001 - 11000).cast("double") / F.lit(10000.0)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content with mentions and the test score of each."""
    scores = F.transform(
        "projects_mentions",
        lambda m: F.struct(
            m["project"].alias("project"),
            F.lit("").alias("summary"),
            polarity_of(F.col("text"), m["project"], m["mentions"]).alias("polarity"),
        ),
    )
    return mentioned(spark, sf_dir).withColumn(
        "projects_mentions_polarity", scores.cast(POLARITY_TYPE)
    )


def example_scorer():
    """The test score as a batch scorer. It is not told the counts, so the
    number of projects of the text takes their place."""

    def score(batch):
        results = []
        for projects, text in batch:
            base = len(text) * 7919 + len(projects) * 31
            results.append(
                [
                    (p, f"{p}: {len(text)}", ((base + len(p) * 17) % 22001 - 11000) / 10000.0)
                    for p in projects
                ]
            )
        return results

    return score


def tracked_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as the project dimension: a project per brand, its types as
    categories, and no package for the brands of one digit."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("project_name"))
        .agg(F.array_sort(F.collect_set("p_type")).alias("project_categories"))
        .select(
            "project_name",
            F.array(F.lower("project_name")).alias("project_search_terms"),
            F.when(F.length("project_name") > 7, F.col("project_name")).alias("pypi_project_name"),
            "project_categories",
        )
    )


# --- raw records -------------------------------------------------------------


def submission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as raw submission records, one JSON text each. Some lack
    what the model asks for."""
    doc, n = F.col("doc_id"), F.col("n_chars")
    flag = F.lit(False)
    record = F.struct(
        *[flag.alias(c) for c in _FALSE_FLAGS],
        (F.col("lang") == "en").alias("is_self"),
        (doc % 11 == 0).alias("stickied"),
        *[F.lit(0).alias(c) for c in ("downs", "gilded", "num_crossposts", "total_awards_received")],
        (n % 50).alias("num_comments"),
        F.lit(6).alias("pwls"),
        F.lit(6).alias("wls"),
        # A score in quotes is not a number.
        F.when(F.col("source") == "src3", F.parse_json(F.concat(F.lit('"'), n.cast("string"), F.lit('"'))))
        .otherwise(F.parse_json(n.cast("string")))
        .alias("score"),
        n.alias("ups"),
        F.lit(1000).alias("subreddit_subscribers"),
        _epoch(doc).alias("created"),
        _epoch(doc).alias("created_utc"),
        F.lit(0.75).alias("upvote_ratio"),
        # Never edited, or when.
        F.when(doc % 3 == 0, F.parse_json(F.lit("false")))
        .when(doc % 3 == 1, F.parse_json(_epoch(doc).cast("long").cast("string")))
        .otherwise(F.parse_json(F.lit("1735700000.5")))
        .alias("edited"),
        F.create_map(F.lit("gid_1"), (doc % 4).cast("int")).alias("gildings"),
        F.array(F.col("lang"), F.col("source")).alias("treatment_tags"),
        F.array().cast("array<string>").alias("user_reports"),
        F.struct(n.alias("width")).alias("media"),
        F.lit(None).cast("string").alias("media_embed"),
        F.lit(None).cast("string").alias("secure_media"),
        doc.cast("string").alias("id"),
        F.concat(F.lit("t3_"), doc).alias("name"),
        F.concat(F.lit("/r/"), F.col("source"), F.lit("/"), doc).alias("permalink"),
        F.col("text").alias("selftext"),
        F.concat(F.lit("t5_"), F.col("source")).alias("subreddit_id"),
        F.concat(F.lit("r/"), F.upper("source")).alias("subreddit_name_prefixed"),
        # A title is required.
        F.when(F.col("lang") != "es", F.concat_ws(" ", "lang", "source")).alias("title"),
        F.concat(F.lit("https://example.org/"), doc).alias("url"),
        *[F.lit(None).cast("string").alias(c) for c in _EMPTY_TEXTS],
    )
    whole = F.to_json(record, {"ignoreNullFields": "false"})
    # One source forgets a key.
    line = F.when(F.col("source") == "src5", F.replace(whole, F.lit('"permalink"'), F.lit('"link"')))
    return table(spark, sf_dir, "documents").select(
        F.upper("source").alias("subreddit"), line.otherwise(whole).alias("value")
    )


_FALSE_FLAGS = (
    "archived clicked hidden hide_score is_created_from_ads_ui is_meta is_original_content"
    " is_reddit_media_domain is_video locked media_only no_follow over_18 pinned quarantine"
    " saved send_replies spoiler"
).split()
_EMPTY_TEXTS = (
    "author_flair_css_class author_flair_text category distinguished domain"
    " link_flair_css_class link_flair_text removed_by_category selftext_html subreddit_type"
    " thumbnail"
).split()


def _epoch(number: Column) -> Column:
    """Half past eight in the evening of the row's day."""
    return F.lit(CONTENT_EPOCH + 73_800.5) + (number % 60) * 86_400


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as raw comment records."""
    conv, turn = F.col("conv_id"), F.col("turn")
    key = conv * 100 + turn
    record = F.struct(
        *[
            F.lit(False).alias(c)
            for c in "archived collapsed locked no_follow score_hidden send_replies stickied".split()
        ],
        (F.col("role") == "user").alias("is_submitter"),
        *[F.lit(0).alias(c) for c in "controversiality downs gilded total_awards_received".split()],
        F.length("text").alias("score"),
        F.length("text").alias("ups"),
        _epoch(conv).alias("created_utc"),
        F.create_map(F.lit("gid_1"), turn.cast("int")).alias("gildings"),
        F.array().cast("array<string>").alias("awarders"),
        F.array("role").alias("treatment_tags"),
        F.col("text").alias("body"),
        (turn > 3).alias("edited"),
        key.cast("string").alias("id"),
        F.concat(F.lit("t3_"), conv).alias("link_id"),
        F.concat(F.lit("t1_"), key).alias("name"),
        F.concat(F.lit("t3_"), conv).alias("parent_id"),
        F.concat(F.lit("/c/"), key).alias("permalink"),
        F.lit("t5_chat").alias("subreddit_id"),
        F.lit("r/Chat").alias("subreddit_name_prefixed"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in (
                "author_fullname author_flair_css_class author_flair_text body_html"
                " collapsed_reason collapsed_reason_code distinguished subreddit_type"
            ).split()
        ],
    )
    return table(spark, sf_dir, "conversations").select(
        F.lit("Chat").alias("subreddit"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("value"),
    )


def write_lines(lines: DataFrame, folder: str) -> None:
    lines.select("value").write.text(folder)


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Both kinds of raw records as files under one new prefix."""
    prefix = storage.scratch(spark, "raw")
    write_lines(submission_lines(spark, sf_dir), f"{prefix}/documents_submissions.json")
    write_lines(comment_lines(spark, sf_dir), f"{prefix}/chats_comments.json")
    return prefix


