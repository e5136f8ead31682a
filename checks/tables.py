"""Queries that write tables and read them back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks import bindings as b
from checks import sql
from checks.content import _averages, _rounded
from checks.downloads import event_downloads
from checks.functions import FETCHED_AT
from checks.registry import query
from tidemark import storage
from tidemark.functions.dates import date_literal
from tidemark.operators import layout, sinks
from tidemark.operators.mentions import project_comments, project_submissions, union_content
from tidemark.operators.upsert import PUBLISH_KEYS, left_anti_on, upsert
from tidemark.operators.windows import pypi_cumulative
from tidemark.plans import content as content_jobs
from tidemark.plans import downloads as download_jobs
from tidemark.plans.dimensions import build_dims
from tidemark.schemas import (
    COMMENT_RECORD,
    COMMENTS,
    CUMULATIVE_DOWNLOADS,
    CUMULATIVE_MENTIONS,
    DAILY_MENTIONS,
    DAILY_PROJECT_DOWNLOADS,
    DOWNLOADS,
    INVALID_DOWNLOADS,
    MENTIONS,
    POLARITY_CATEGORIES,
    SUBMISSION_RECORD,
    SUBMISSIONS,
    TRACKED_PROJECTS,
    TRACKED_SUBREDDITS,
)
from tidemark.sources.dimensions import project_rows, with_subreddit_url
from tidemark.sources.json_lines import records_folder, scan_comments, scan_json, validated
from tidemark.sources.tables import scan_table, scan_table_partition
from tidemark.sources.validation import check_records
from tidemark.streaming.ingest import ingest_new_files

# Counts of the driver's tables may outgrow INT.
WIDE = DOWNLOADS.widened()
WIDE_CUMULATIVE = CUMULATIVE_DOWNLOADS.widened()
WIDE_DAILY = DAILY_PROJECT_DOWNLOADS.widened()
EVD = sql.EVENT_DOWNLOADS


def _new(spark, label="table"):
    return storage.scratch(spark, label)


def _written(spark, sf_dir):
    path = _new(spark)
    sinks.overwrite_partitions(event_downloads(spark, sf_dir), path, WIDE)
    return path


# --- partitions --------------------------------------------------------------


@query("scan_table", sql.select(EVD, "SELECT * FROM evd"))
def scan_table_(spark, sf_dir):
    return scan_table(spark, _written(spark, sf_dir), WIDE)


@query(
    "scan_table_partition",
    sql.select(EVD, "SELECT * FROM evd WHERE download_date = DATE '2024-01-10'"),
)
def scan_table_partition_(spark, sf_dir):
    return scan_table_partition(spark, _written(spark, sf_dir), WIDE, "download_date", "2024-01-10")


@query(
    "sink_overwrite_partitions",
    sql.select(
        EVD,
        "SELECT * REPLACE (CASE WHEN download_date >= DATE '2024-01-15' THEN 2 * download_count"
        " ELSE download_count END AS download_count) FROM evd",
    ),
)
def sink_overwrite_partitions(spark, sf_dir):
    path = _written(spark, sf_dir)
    later = event_downloads(spark, sf_dir).where(
        F.col("download_date") >= date_literal("2024-01-15")
    )
    doubled = later.withColumn("download_count", F.col("download_count") * 2)
    sinks.overwrite_partitions(doubled, path, WIDE)
    return scan_table(spark, path, WIDE)


@query(
    "replace_partition",
    sql.select(
        EVD,
        "SELECT * FROM evd WHERE download_date NOT IN (DATE '2024-01-10', DATE '2024-01-11')"
        " OR download_date = DATE '2024-01-10' AND project = 'click'",
    ),
)
def replace_partition(spark, sf_dir):
    """One day is rebuilt from some projects, the next from none."""
    path = _written(spark, sf_dir)
    rows = event_downloads(spark, sf_dir)
    day = rows.where("project = 'click' AND download_date = DATE '2024-01-10'")
    sinks.replace_partition(day, path, WIDE, "2024-01-10")
    sinks.replace_partition(rows.where("project = 'no such project'"), path, WIDE, "2024-01-11")
    return scan_table(spark, path, WIDE)


@query("create_table", sql.select(EVD, "SELECT * FROM evd"))
def create_table(spark, sf_dir):
    """Created empty, filled, and created again, which changes nothing."""
    path = _new(spark)
    sinks.create_table(spark, path, WIDE)
    sinks.overwrite_partitions(event_downloads(spark, sf_dir), path, WIDE)
    sinks.create_table(spark, path, WIDE)
    return scan_table(spark, path, WIDE)


@query("compact_partition", sql.select(EVD, "SELECT * FROM evd"))
def compact_partition(spark, sf_dir):
    """Many small files of a day become one; the rows stay."""
    path = _new(spark)
    rows = layout.laid_out(event_downloads(spark, sf_dir), WIDE).repartition(8, "country_code", "python")
    rows.write.partitionBy(WIDE.partition).parquet(path)
    sinks.compact_partition(spark, path, WIDE, "2024-01-10")
    return scan_table(spark, path, WIDE)


@query(
    "retention_delete",
    sql.select(EVD, "SELECT * FROM evd WHERE download_date >= DATE '2024-01-15'"),
)
def retention_delete(spark, sf_dir):
    path = _written(spark, sf_dir)
    sinks.drop_expired(spark, path, WIDE, "2024-01-30", 15)
    return scan_table(spark, path, WIDE)


@query("export_clustered_parquet", sql.select(EVD, "SELECT * FROM evd"))
def export_clustered_parquet(spark, sf_dir):
    target = sinks.export_clustered(event_downloads(spark, sf_dir), _new(spark, "export"), "2024-01-30")
    return spark.read.schema(WIDE.schema).parquet(target)


@query("repartition_by_hash", sql.select(EVD, "SELECT * FROM evd"))
def repartition_by_hash(spark, sf_dir):
    return layout.repartition_by(event_downloads(spark, sf_dir), "project")


@query("sort_within_partitions", sql.select(EVD, "SELECT * FROM evd"))
def sort_within_partitions(spark, sf_dir):
    return layout.clustered(event_downloads(spark, sf_dir))


def _dimension_texts(df):
    return df.select(
        "project_name",
        F.array_join("project_search_terms", "|").alias("terms"),
        "pypi_project_name",
        F.array_join("project_categories", "|").alias("categories"),
    )


_BRAND_ROWS = sql.select(
    sql.BRANDS,
    "SELECT project_name, term AS terms, pypi_project_name,"
    " array_to_string(project_categories, '|') AS categories FROM brands",
)


@query("full_refresh", _BRAND_ROWS)
def full_refresh(spark, sf_dir):
    """The second load replaces every row of the first."""
    path = _new(spark)
    brands = b.tracked_brands(spark, sf_dir)
    sinks.full_refresh(brands.withColumn("pypi_project_name", F.lit("old")), path, TRACKED_PROJECTS)
    sinks.full_refresh(brands, path, TRACKED_PROJECTS)
    return _dimension_texts(scan_table(spark, path, TRACKED_PROJECTS))


_DIM_ROWS = sql.select(
    f"{sql.BRANDS}, {sql.BANDS}",
    "SELECT 'projects' AS dim, project_name AS name, term || '/' || coalesce(pypi_project_name, '') || '/'"
    " || array_to_string(project_categories, '|') AS what, NULL::DOUBLE AS low, NULL::DOUBLE AS high FROM brands"
    " UNION ALL SELECT DISTINCT 'subreddits', source, 'https://reddit.com/r/' || lower(source), NULL, NULL FROM documents"
    " UNION ALL SELECT 'bands', polarity_category, (row_number() OVER (ORDER BY lo))::VARCHAR, lo, hi FROM bands",
)


@query("build_dims", _DIM_ROWS)
def build_dims_(spark, sf_dir):
    """All three dimensions, projects and subreddits out of the data."""
    named = b.table(spark, sf_dir, "documents").select(F.col("source").alias("subreddit_name"))
    paths = build_dims(
        spark,
        _new(spark, "dims"),
        projects=b.tracked_brands(spark, sf_dir),
        subreddits=with_subreddit_url(named.distinct()),
    )
    none = F.lit(None).cast("double")
    projects = _dimension_texts(scan_table(spark, paths[TRACKED_PROJECTS.name], TRACKED_PROJECTS)).select(
        F.lit("projects").alias("dim"),
        F.col("project_name").alias("name"),
        F.concat_ws("/", "terms", F.coalesce("pypi_project_name", F.lit("")), "categories").alias("what"),
        none.alias("low"),
        none.alias("high"),
    )
    names = scan_table(spark, paths[TRACKED_SUBREDDITS.name], TRACKED_SUBREDDITS).select(
        F.lit("subreddits"), "subreddit_name", "subreddit_url", none, none
    )
    bands = scan_table(spark, paths[POLARITY_CATEGORIES.name], POLARITY_CATEGORIES).select(
        F.lit("bands"),
        "polarity_category",
        F.col("polarity_category_order").cast("string"),
        "polarity_lower_bound",
        "polarity_upper_bound",
    )
    return projects.union(names).union(bands)


@query(
    "append_quarantine",
    sql.select(
        sql.STAGED,
        "SELECT *, DATE '2024-01-30' AS run_date FROM staged WHERE country_code = 'us'"
        " UNION ALL SELECT *, DATE '2024-01-31' FROM staged WHERE download_count <= 0",
    ),
)
def append_quarantine(spark, sf_dir):
    """Two runs add up; a run that is repeated does not."""
    path = _new(spark, "quarantine")
    staged = b.staged_lines(spark, sf_dir)
    for run_date, rows in (
        ("2024-01-30", staged.where("country_code = 'us'")),
        ("2024-01-31", staged.where("download_count <= 0")),
        ("2024-01-31", staged.where("download_count <= 0")),
    ):
        sinks.append_quarantine(rows, path, run_date)
    return scan_table(spark, path, INVALID_DOWNLOADS)


def _rollup_sql(day: str) -> str:
    """One day's rollup as a subquery, NULL keys without windows."""
    known = "project IS NOT NULL AND project_version IS NOT NULL AND country_code IS NOT NULL"
    sums = ", ".join(
        f"CASE WHEN {known} THEN COALESCE(SUM(download_count) FILTER"
        f" (WHERE {sql.in_window('download_date', day, d)}), 0) ELSE 0 END::BIGINT"
        f" AS download_count{sql.suffix(d)}"
        for d in sql.WINDOWS[:-1]
    )
    return (
        f"SELECT DATE '{day}' AS reference_date, project, project_version, country_code, {sums},"
        " SUM(download_count)::BIGINT AS download_count_since_first_record FROM evd"
        " GROUP BY project, project_version, country_code"
    )


@query(
    "load_serving_incremental",
    sql.select(EVD, f"{_rollup_sql('2024-01-20')} UNION ALL {_rollup_sql('2024-01-30')}"),
)
def load_serving_incremental(spark, sf_dir):
    """Three days are loaded, one of them twice; the first is past retention
    when the last comes in."""
    path = _new(spark, "serving")
    rows = event_downloads(spark, sf_dir)
    for day in ("2024-01-05", "2024-01-20", "2024-01-20", "2024-01-30"):
        snapshot = pypi_cumulative(rows, day)
        sinks.load_serving(spark, snapshot, path, WIDE_CUMULATIVE, day, retention_days=10)
    return scan_table(spark, path, WIDE_CUMULATIVE)


@query(
    "select_partition_star",
    sql.select(EVD, _rollup_sql("2024-01-20")),
)
def select_partition_star(spark, sf_dir):
    path = _new(spark)
    rows = event_downloads(spark, sf_dir)
    for day in ("2024-01-19", "2024-01-20"):
        sinks.replace_partition(pypi_cumulative(rows, day), path, WIDE_CUMULATIVE, day)
    return scan_table_partition(spark, path, WIDE_CUMULATIVE, "reference_date", "2024-01-20")


# --- merges ------------------------------------------------------------------

# Production holds three projects; staging brings all, counted twice, and has
# lost some versions.
_STAGED_EVENTS = (
    "stg AS (SELECT * REPLACE (nullif(project_version, '9') AS project_version,"
    " 2 * download_count AS download_count) FROM evd)"
)
_PRODUCTION = "prod AS (SELECT * FROM evd WHERE project IN ('click', 'view', 'purchase'))"
_MATCH = (
    "s.download_date = t.download_date AND s.project = t.project"
    " AND s.project_version = t.project_version AND COALESCE(s.python, '') = COALESCE(t.python, '')"
    " AND COALESCE(s.system_name, '') = COALESCE(t.system_name, '')"
    " AND COALESCE(s.country_code, '') = COALESCE(t.country_code, '')"
)


def _merged_sql(staged: str) -> str:
    return sql.select(
        f"{EVD}, {staged}, {_PRODUCTION}",
        f"SELECT * FROM prod t WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE {_MATCH})"
        " UNION ALL SELECT * FROM stg",
    )


def _merge_events(spark, sf_dir, staged):
    path = _new(spark)
    rows = event_downloads(spark, sf_dir)
    production = rows.where(F.col("project").isin("click", "view", "purchase"))
    sinks.overwrite_partitions(production, path, WIDE)
    upsert(spark, staged(rows), path, WIDE, PUBLISH_KEYS)
    return scan_table(spark, path, WIDE)


def _doubled(rows):
    return rows.withColumn("download_count", F.col("download_count") * 2)


@query("publish_merge", _merged_sql(_STAGED_EVENTS))
def publish_merge(spark, sf_dir):
    lost = F.nullif(F.col("project_version"), F.lit("9"))
    return _merge_events(spark, sf_dir, lambda rows: _doubled(rows).withColumn("project_version", lost))


@query(
    "merge_match_coalesced",
    _merged_sql(
        "stg AS (SELECT * REPLACE (COALESCE(system_name, '') AS system_name,"
        " COALESCE(country_code, '') AS country_code, 2 * download_count AS download_count) FROM evd)"
    ),
)
def merge_match_coalesced(spark, sf_dir):
    """Blank and NULL are one key: the blanks of the source replace NULLs."""
    blanks = {c: F.coalesce(F.col(c), F.lit("")) for c in ("system_name", "country_code")}
    return _merge_events(spark, sf_dir, lambda rows: _doubled(rows).withColumns(blanks))


@query(
    "join_left_anti",
    "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS"
    " (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def join_left_anti(spark, sf_dir):
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return left_anti_on(documents, b.table(spark, sf_dir, "labels"), ["doc_id"])


# --- raw records -------------------------------------------------------------

_SUBMISSION_SQL = """SELECT doc_id::VARCHAR AS id,
  CASE WHEN lang <> 'es' THEN lang || ' ' || source END AS title, text AS selftext,
  CASE WHEN source <> 'src3' THEN n_chars::INTEGER END AS score, n_chars::INTEGER AS ups,
  lang = 'en' AS is_self, (1735763400.5 + (doc_id % 60) * 86400)::DOUBLE AS created_utc,
  0.75::DOUBLE AS upvote_ratio, CASE doc_id % 3 WHEN 0 THEN 'false' WHEN 1 THEN
    (1735763400 + (doc_id % 60) * 86400)::BIGINT::VARCHAR ELSE '1735700000.5' END AS edited,
  (doc_id % 4)::INTEGER AS gid_1, lang || '|' || source AS treatment_tags,
  '{"width":' || n_chars || '}' AS media,
  CASE WHEN source <> 'src5' THEN '/r/' || source || '/' || doc_id END AS permalink
FROM documents"""
_COMMENT_SQL = """SELECT (conv_id * 100 + turn)::VARCHAR AS id, text AS body,
  length(text)::INTEGER AS score, role = 'user' AS is_submitter,
  (1735763400.5 + (conv_id % 60) * 86400)::DOUBLE AS created_utc,
  CASE WHEN turn > 3 THEN 'true' ELSE 'false' END AS edited, turn::INTEGER AS gid_1,
  role AS treatment_tags, 't3_' || conv_id AS link_id
FROM conversations"""


def _submission_view(df):
    return df.select(
        "id", "title", "selftext", "score", "ups", "is_self", "created_utc", "upvote_ratio", "edited",
        F.col("gildings")["gid_1"].alias("gid_1"),
        F.array_join("treatment_tags", "|").alias("treatment_tags"),
        "media", "permalink",
    )


def _comment_view(df):
    return df.select(
        "id", "body", "score", "is_submitter", "created_utc", "edited",
        F.col("gildings")["gid_1"].alias("gid_1"),
        F.array_join("treatment_tags", "|").alias("treatment_tags"),
        "link_id",
    )


@query("scan_json_submissions", _SUBMISSION_SQL)
def scan_json_submissions(spark, sf_dir):
    folder = f"{_new(spark, 'raw')}/documents_submissions.json"
    b.write_lines(b.submission_lines(spark, sf_dir), folder)
    return _submission_view(scan_json(spark, [folder], SUBMISSION_RECORD))


@query("scan_json_comments", _COMMENT_SQL)
def scan_json_comments(spark, sf_dir):
    folder = f"{_new(spark, 'raw')}/chats_comments.json"
    b.write_lines(b.comment_lines(spark, sf_dir), folder)
    return _comment_view(scan_json(spark, [folder], COMMENT_RECORD))


@query("scan_select_files", _COMMENT_SQL)
def scan_select_files(spark, sf_dir):
    """Of both kinds of files under a prefix, those of one."""
    return _comment_view(scan_comments(spark, b.raw_files(spark, sf_dir)))


@query(
    "add_null_columns",
    "SELECT doc_id::VARCHAR AS id, NULL::VARCHAR AS parent_whitelist_status,"
    " NULL::VARCHAR AS whitelist_status FROM documents",
)
def add_null_columns(spark, sf_dir):
    rows = b.document_content(spark, sf_dir).select("id")
    return content_jobs.add_null_columns(rows)


def _normalised(title: str, table: str, id_: str, day: str, subreddit: str, link: str, score: str) -> str:
    kind = "submission" if table == "documents" else "comment"
    return (
        f"SELECT '{kind}' AS content_type, (1735763400.5 + ({day} % 60) * 86400)::DOUBLE AS created_utc,"
        f" DATE '2025-01-01' + ({day} % 60)::INTEGER AS created_date, {title} AS title,"
        f" {id_} AS id, {subreddit} AS subreddit, text, {link} AS permalink, {score} AS score"
        f" FROM {table}"
    )


_NORMAL_SUBMISSIONS = _normalised(
    "CASE WHEN lang <> 'es' THEN lang || ' ' || source END", "documents", "doc_id::VARCHAR", "doc_id",
    "'r/' || upper(source)", "CASE WHEN source <> 'src5' THEN '/r/' || source || '/' || doc_id END",
    "CASE WHEN source <> 'src3' THEN n_chars::INTEGER END",
)
_NORMAL_COMMENTS = _normalised(
    "''", "conversations", "(conv_id * 100 + turn)::VARCHAR", "conv_id", "'r/Chat'",
    "'/c/' || (conv_id * 100 + turn)", "length(text)::INTEGER",
)


def _submissions(spark, sf_dir):
    folder = f"{_new(spark, 'raw')}/documents_submissions.json"
    b.write_lines(b.submission_lines(spark, sf_dir), folder)
    return content_jobs.prepared(scan_json(spark, [folder], SUBMISSION_RECORD), "submissions")


def _comments(spark, sf_dir):
    folder = f"{_new(spark, 'raw')}/chats_comments.json"
    b.write_lines(b.comment_lines(spark, sf_dir), folder)
    return content_jobs.prepared(scan_json(spark, [folder], COMMENT_RECORD), "comments")


@query("project_submissions", _NORMAL_SUBMISSIONS)
def project_submissions_(spark, sf_dir):
    return project_submissions(_submissions(spark, sf_dir))


@query("project_comments", _NORMAL_COMMENTS)
def project_comments_(spark, sf_dir):
    return project_comments(_comments(spark, sf_dir))


@query("union_content", f"{_NORMAL_SUBMISSIONS} UNION ALL {_NORMAL_COMMENTS}")
def union_content_(spark, sf_dir):
    return union_content(_submissions(spark, sf_dir), _comments(spark, sf_dir))


# What is wrong with a record, by the defects the binding gives it.
_ERROR = (
    "concat_ws('; ', CASE WHEN source = 'src3' THEN 'score: not a integer' END,"
    " CASE WHEN source = 'src5' THEN 'permalink: missing' END,"
    " CASE WHEN lang = 'es' THEN 'title: null' END)"
)


@query(
    "validate_records",
    f"SELECT doc_id::VARCHAR AS id, {_ERROR} = '' AS valid, {_ERROR} AS error FROM documents",
)
def validate_records(spark, sf_dir):
    checked = check_records(b.submission_lines(spark, sf_dir), "submissions")
    return checked.select(
        F.get_json_object("value", "$.id").alias("id"),
        (F.size("errors") == 0).alias("valid"),
        F.concat_ws("; ", "errors").alias("error"),
    )


_EDITED_FLOAT = (
    "CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN"
    " (1735763400 + (doc_id % 60) * 86400)::BIGINT::VARCHAR || '.0' ELSE '1735700000.5' END"
)


@query(
    "sink_json_lines",
    f"SELECT doc_id::VARCHAR AS id, lower(source) AS subreddit, {_ERROR} = '' AS valid,"
    f" CASE WHEN {_ERROR} = '' THEN {_EDITED_FLOAT} END AS edited,"
    f" CASE WHEN {_ERROR} <> '' THEN {_ERROR} END AS error FROM documents",
)
def sink_json_lines(spark, sf_dir):
    root = _new(spark, "records")
    content_jobs.ingest_records(b.submission_lines(spark, sf_dir), root, "submissions", FETCHED_AT)
    valid = spark.read.schema("id string, edited string, subreddit string").json(
        records_folder(root, "submissions", "valid", b.FETCHED)
    )
    valid = validated(valid)
    invalid = spark.read.schema(
        "invalid_record struct<id: string>, error string, subreddit string"
    ).json(records_folder(root, "submissions", "invalid", b.FETCHED))
    return valid.select(
        "id", "subreddit", F.lit(True).alias("valid"), "edited", F.lit(None).cast("string").alias("error")
    ).unionByName(
        invalid.select(
            F.col("invalid_record.id").alias("id"),
            "subreddit",
            F.lit(False).alias("valid"),
            F.lit(None).cast("string").alias("edited"),
            "error",
        )
    )


# --- content tables ----------------------------------------------------------

# The second load brings the labelled documents again, later and with another
# score, and the pages as new submissions.
_MONTH_LATER = "DATE '2025-01-01' + (doc_id % 60 + 31)::INTEGER"
_UPSERTED = f"""WITH again AS (
  SELECT d.doc_id, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT d.doc_id::VARCHAR AS id, d.text AS selftext,
  CASE WHEN a.doc_id IS NOT NULL THEN a.quality::INTEGER ELSE d.n_chars::INTEGER END AS score,
  CASE WHEN a.doc_id IS NOT NULL THEN {_MONTH_LATER.replace("doc_id", "d.doc_id")}
    ELSE DATE '2025-01-01' + (d.doc_id % 60)::INTEGER END AS created_date
FROM documents d LEFT JOIN again a ON d.doc_id = a.doc_id
UNION ALL
SELECT 'page' || page_id, html, 1, DATE '2025-01-01' + (page_id % 60)::INTEGER FROM pages"""


def _sparse(df, table):
    """The columns at hand as rows of a table, NULL for the others."""
    return df.to(table.schema)


def _first_submissions(spark, sf_dir):
    doc = F.col("doc_id")
    return b.table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("id"),
        F.col("text").alias("selftext"),
        F.col("n_chars").alias("score"),
        b.content_day(doc).alias("created_date"),
    )


def _second_submissions(spark, sf_dir):
    labelled = b.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality")
    again = (
        _first_submissions(spark, sf_dir)
        .join(labelled, "id")
        .select(
            "id",
            "selftext",
            F.col("quality").alias("score"),
            F.date_add("created_date", 31).alias("created_date"),
        )
    )
    pages = b.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page"), "page_id").alias("id"),
        F.col("html").alias("selftext"),
        F.lit(1).alias("score"),
        b.content_day(F.col("page_id")).alias("created_date"),
    )
    return again.unionByName(pages)


@query("upsert_by_id_submissions", _UPSERTED)
def upsert_by_id_submissions(spark, sf_dir):
    path = _new(spark)
    for rows in (_first_submissions(spark, sf_dir), _second_submissions(spark, sf_dir)):
        sinks.create_table(spark, path, SUBMISSIONS)
        upsert(spark, _sparse(rows, SUBMISSIONS), path, SUBMISSIONS)
    return scan_table(spark, path, SUBMISSIONS).select("id", "selftext", "score", "created_date")


@query(
    "upsert_by_id_comments",
    "SELECT (conv_id * 100 + turn)::VARCHAR AS id, text AS body,"
    " CASE WHEN role = 'assistant' THEN -1 ELSE turn::INTEGER END AS score,"
    " DATE '2025-01-01' + (conv_id % 60)::INTEGER AS created_date FROM conversations",
)
def upsert_by_id_comments(spark, sf_dir):
    """All turns after the first load of two roles; the assistant's again."""
    path = _new(spark)
    rows = b.table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("id"),
        F.col("text").alias("body"),
        F.when(F.col("role") == "assistant", -1).otherwise(F.col("turn")).alias("score"),
        b.content_day(F.col("conv_id")).alias("created_date"),
        "role",
    )
    first = rows.where("role <> 'user'").withColumn("score", F.lit(0))
    first = first.withColumn("score", F.when(F.col("role") == "system", 0).otherwise(7))
    second = rows.where("role <> 'system'")
    sinks.create_table(spark, path, COMMENTS)
    for batch in (first, second):
        upsert(spark, _sparse(batch, COMMENTS), path, COMMENTS)
    return scan_table(spark, path, COMMENTS).select("id", "body", "score", "created_date")


_LOADED = f"{_NORMAL_SUBMISSIONS} UNION ALL {_NORMAL_COMMENTS}"
_VALID = f"SELECT * FROM ({_NORMAL_SUBMISSIONS}) WHERE id IN (SELECT doc_id::VARCHAR FROM documents WHERE {_ERROR} = '')"


@query("load_content", _LOADED)
def load_content(spark, sf_dir):
    """A day's files, merged twice, which is the same as once."""
    source, submissions, comments = b.raw_files(spark, sf_dir), _new(spark), _new(spark)
    for _ in range(2):
        content_jobs.load_content(spark, source, submissions, comments)
    return union_content(
        scan_table(spark, submissions, SUBMISSIONS), scan_table(spark, comments, COMMENTS)
    )


@query("validate_then_load", f"{_VALID} UNION ALL {_NORMAL_COMMENTS}")
def validate_then_load(spark, sf_dir):
    """Raw lines, validated, written, and what is valid of them loaded."""
    root, submissions, comments = _new(spark, "records"), _new(spark), _new(spark)
    content_jobs.ingest_records(b.submission_lines(spark, sf_dir), root, "submissions", FETCHED_AT)
    content_jobs.ingest_records(b.comment_lines(spark, sf_dir), root, "comments", FETCHED_AT)
    content_jobs.load_content(spark, root, submissions, comments)
    return union_content(
        scan_table(spark, submissions, SUBMISSIONS), scan_table(spark, comments, COMMENTS)
    )


# Edited records come out as validation keeps them: NULL unless they were.
_INGESTED = _COMMENT_SQL.replace("ELSE 'false' END AS edited", "END AS edited")


@query("incremental_file_ingest", _INGESTED)
def incremental_file_ingest(spark, sf_dir):
    """Two runs of the stream over the folder that validation writes: the first
    finds two days that hold the same records, the second a third day."""
    root, path, state = _new(spark, "records"), _new(spark), _new(spark, "stream")
    lines = b.comment_lines(spark, sf_dir)
    for days in ((0, 1), (2,)):
        for day in days:
            content_jobs.ingest_records(lines, root, "comments", FETCHED_AT + timedelta(days=day))
        ingest_new_files(spark, root, "comments", path, state).awaitTermination()
    return _comment_view(scan_table(spark, path, COMMENTS))


# --- jobs --------------------------------------------------------------------

_DAY = "2024-01-10"
_ONE_DAY = f"evd WHERE {_DAY!r}::DATE = download_date AND project IN ('click', 'view', 'purchase')"


@query("ingest_downloads", sql.select(EVD, f"SELECT * FROM {_ONE_DAY}"))
def ingest_downloads(spark, sf_dir):
    path = _new(spark, "staging")
    events = b.raw_events(spark, sf_dir)
    download_jobs.ingest_downloads(events, _DAY, "2024-01-11", b.EVENT_PROJECTS, path, WIDE)
    return scan_table(spark, path, WIDE)


@query(
    "backfill_downloads",
    sql.select(
        EVD,
        "SELECT * FROM evd WHERE download_date >= DATE '2024-01-05' AND download_date <"
        " DATE '2024-01-20' AND project IN ('click', 'view', 'purchase')",
    ),
)
def backfill_downloads(spark, sf_dir):
    path = _new(spark)
    download_jobs.backfill_downloads(
        b.raw_events(spark, sf_dir), b.EVENT_START, b.EVENT_END, b.EVENT_PROJECTS, path, WIDE
    )
    return scan_table(spark, path, WIDE)


def _published(spark, sf_dir):
    """Two days published one after the other, the first of them twice. The
    country code zz is valid, so the audit passes."""
    staging, invalid, production = _new(spark, "staging"), _new(spark, "invalid"), _new(spark)
    events = b.raw_events(spark, sf_dir)
    for day in (_DAY, "2024-01-11", _DAY):
        download_jobs.publish_downloads(
            spark, events, day, b.EVENT_PROJECTS, staging, invalid, production, tolerance=0.5, table=WIDE
        )
    return staging, invalid, production


_TWO_DAYS = (
    "evd WHERE download_date IN (DATE '2024-01-10', DATE '2024-01-11')"
    " AND project IN ('click', 'view', 'purchase')"
)


@query("publish_downloads", sql.select(EVD, f"SELECT * FROM {_TWO_DAYS}"))
def publish_downloads(spark, sf_dir):
    _, _, production = _published(spark, sf_dir)
    return scan_table(spark, production, WIDE)


@query(
    "staging_cleanup",
    sql.select(
        EVD,
        "SELECT 'production' AS table_name, COUNT(*) AS rows_left FROM evd UNION ALL SELECT 'staging', 0",
    ),
)
def staging_cleanup(spark, sf_dir):
    """Staging is empty after its rows are published."""
    staging, production = _written(spark, sf_dir), _new(spark)
    download_jobs.publish_staged(spark, staging, production, WIDE)
    counts = [
        scan_table(spark, path, WIDE).agg(F.lit(name).alias("table_name"), F.count("*").alias("rows_left"))
        for name, path in (("production", production), ("staging", staging))
    ]
    return counts[0].unionByName(counts[1])


@query("aggregate_downloads", sql.select(EVD, _rollup_sql("2024-01-20")))
def aggregate_downloads(spark, sf_dir):
    source, path = _written(spark, sf_dir), _new(spark)
    for _ in range(2):
        download_jobs.aggregate_downloads(spark, source, path, "2024-01-20", WIDE, WIDE_CUMULATIVE)
    return scan_table(spark, path, WIDE_CUMULATIVE)


@query("aggregate_downloads_incremental", sql.select(EVD, _rollup_sql("2024-01-30")))
def aggregate_downloads_incremental(spark, sf_dir):
    """The last day's rollup on top of the one before it, out of six days."""
    source, path = _new(spark), _new(spark)
    rows = event_downloads(spark, sf_dir)
    last = F.col("download_date") == date_literal("2024-01-30")
    sinks.overwrite_partitions(rows.where(~last), source, WIDE)
    download_jobs.aggregate_downloads(spark, source, path, "2024-01-29", WIDE, WIDE_CUMULATIVE)
    sinks.overwrite_partitions(rows.where(last), source, WIDE)
    download_jobs.aggregate_downloads(
        spark, source, path, "2024-01-30", WIDE, WIDE_CUMULATIVE, incremental=True
    )
    return scan_table_partition(spark, path, WIDE_CUMULATIVE, "reference_date", "2024-01-30")


@query("aggregate_downloads_prefix", sql.select(EVD, _rollup_sql("2024-01-30")))
def aggregate_downloads_prefix(spark, sf_dir):
    """The last day's rollup out of running sums, which are built for the days
    up to the one before, one of these with wrong counts and then again."""
    source, path, prefix = _new(spark), _new(spark), _new(spark)
    rows = event_downloads(spark, sf_dir)
    day = F.col("download_date")
    again, last = day == date_literal("2024-01-20"), day == date_literal("2024-01-30")
    wrong = F.when(again, F.col("download_count") * 3).otherwise(F.col("download_count"))
    sinks.overwrite_partitions(rows.where(~last).withColumn("download_count", wrong), source, WIDE)
    for changed, ds in ((None, "2024-01-29"), (again | last, "2024-01-30")):
        if changed is not None:
            sinks.overwrite_partitions(rows.where(changed), source, WIDE)
        download_jobs.aggregate_downloads(spark, source, path, ds, WIDE, WIDE_CUMULATIVE, prefix_path=prefix)
    return scan_table_partition(spark, path, WIDE_CUMULATIVE, "reference_date", "2024-01-30")


@query(
    "load_serving",
    sql.select(
        EVD,
        "SELECT download_date, project, SUM(download_count)::BIGINT AS download_count FROM evd"
        " WHERE download_date <= DATE '2024-01-20' GROUP BY 1, 2 UNION ALL"
        " SELECT reference_date, project, SUM(download_count_last_7_days)::BIGINT"
        f" FROM ({_rollup_sql('2024-01-20')}) GROUP BY 1, 2",
    ),
)
def load_serving(spark, sf_dir):
    """Both serving tables: daily totals, and weekly totals of the snapshot."""
    source, cumulative = _written(spark, sf_dir), _new(spark)
    download_jobs.aggregate_downloads(spark, source, cumulative, "2024-01-20", WIDE, WIDE_CUMULATIVE)
    served, totals = _new(spark, "serving"), _new(spark, "serving")
    download_jobs.serve_downloads(
        spark, cumulative, source, served, totals, "2024-01-20",
        downloads_table=WIDE, cumulative_table=WIDE_CUMULATIVE, daily_table=WIDE_DAILY,
    )
    weekly = (
        scan_table(spark, served, WIDE_CUMULATIVE)
        .groupBy(F.col("reference_date").alias("download_date"), "project")
        .agg(F.sum("download_count_last_7_days").alias("download_count"))
    )
    return scan_table(spark, totals, WIDE_DAILY).unionByName(weekly)


@query("export_dashboard", sql.select(EVD, "SELECT * FROM evd"))
def export_dashboard(spark, sf_dir):
    target = download_jobs.export_dashboard(
        spark, _written(spark, sf_dir), _new(spark, "export"), "2024-01-30", table=WIDE
    )
    return spark.read.schema(WIDE.schema).parquet(target)


_MENTION_DAY = "2025-01-15"


def _content_tables(spark, sf_dir):
    """``documents`` and ``conversations`` in the two content tables."""
    submissions, comments = _new(spark), _new(spark)
    documents = b.document_content(spark, sf_dir).withColumnRenamed("text", "selftext")
    turns = b.conversation_content(spark, sf_dir).withColumnRenamed("text", "body")
    sinks.overwrite_partitions(_sparse(documents, SUBMISSIONS), submissions, SUBMISSIONS)
    sinks.overwrite_partitions(_sparse(turns, COMMENTS), comments, COMMENTS)
    return submissions, comments


_MENTIONS_SQL = sql.select(
    sql.LISTED,
    "SELECT content_type, id, m.project AS project, m.mentions::INTEGER AS mentions,"
    f" {_MENTION_DAY!r}::DATE AS created_date,"
    " ((length(text) * 7919 + length(m.project) * 17 + len(found) * 31) % 22001 - 11000)::DOUBLE"
    " / 10000::DOUBLE AS polarity FROM (SELECT *, unnest(found) AS m FROM listed"
    f" WHERE created_date = DATE '{_MENTION_DAY}')",
)


@query("mentions_job", _MENTIONS_SQL)
def mentions_job(spark, sf_dir):
    submissions, comments = _content_tables(spark, sf_dir)
    path = _new(spark)
    content_jobs.mentions_job(
        spark, _MENTION_DAY, submissions, comments, path, b.PROJECTS, b.example_scorer()
    )
    return _paired(scan_table(spark, path, MENTIONS))


def _paired(written):
    """One row per mention, with its score."""
    pairs = F.arrays_zip("projects_mentions", "projects_mentions_polarity")
    return written.select("content_type", "id", "created_date", F.explode(pairs).alias("p")).select(
        "content_type",
        "id",
        F.col("p.projects_mentions.project").alias("project"),
        F.col("p.projects_mentions.mentions").alias("mentions"),
        "created_date",
        F.col("p.projects_mentions_polarity.polarity").alias("polarity"),
    )


@query("mentions_job_stored", _MENTIONS_SQL)
def mentions_job_stored(spark, sf_dir):
    """The job twice, with a store of scores: the second run, which rewrites
    the day, fails if it calls its scorer."""
    submissions, comments = _content_tables(spark, sf_dir)
    path, scores = _new(spark), _new(spark, "scores")

    def none_left(batch):
        raise ValueError(f"{len(batch)} texts were scored before")

    for scorer in (b.example_scorer(), none_left):
        content_jobs.mentions_job(
            spark, _MENTION_DAY, submissions, comments, path, b.PROJECTS, scorer, scores, "example-1"
        )
    return _paired(scan_table(spark, path, MENTIONS))


@query(
    "aggregate_mentions",
    sql.select(
        sql.DAILY.replace("daily AS (", "all_days AS (")
        + f", daily AS (SELECT * FROM all_days WHERE created_date IN (DATE '2025-01-14', DATE '{_MENTION_DAY}'))"
        + f", {sql.PROJECT_VALUES}, {sql.left_join_star(_MENTION_DAY)}",
        "SELECT * FROM star",
    ),
)
def aggregate_mentions(spark, sf_dir):
    """Two days rolled up one after the other; the second day's result."""
    source, daily, cumulative = _new(spark), _new(spark), _new(spark)
    scored = _sparse(b.scored(spark, sf_dir), MENTIONS)
    sinks.overwrite_partitions(scored, source, MENTIONS)
    projects = project_rows(spark, b.PROJECTS)
    table = CUMULATIVE_MENTIONS.widened()
    for day in ("2025-01-14", _MENTION_DAY):
        content_jobs.aggregate_mentions(
            spark, source, projects, daily, cumulative, day,
            daily_table=DAILY_MENTIONS.widened(), cumulative_table=table,
        )
    rollup = scan_table_partition(spark, cumulative, table, "reference_date", _MENTION_DAY)
    return _rounded(rollup, *_averages(rollup))
