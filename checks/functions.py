"""Queries of the scalar functions, over whole tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import bindings as b
from checks.registry import query
from tidemark import storage
from tidemark.functions import dates, decode, nulls
from tidemark.schemas import SUBMISSION_RECORD
from tidemark.sources.dimensions import with_subreddit_url
from tidemark.sources.json_lines import scan_json
from tidemark.sources.pages import read_pages

FETCHED_AT = datetime(2025, 3, 5, 6, 7, 8, tzinfo=UTC)


@query("fn_date_add", "SELECT o_orderkey, o_orderdate::DATE - 6 AS week_start FROM orders")
def fn_date_add(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_sub(F.to_date("o_orderdate"), 6).alias("week_start")
    )


@query(
    "fn_date_literal",
    f"SELECT o_orderkey, DATE '{b.REFERENCE}' AS reference_date FROM orders"
    f" WHERE o_orderdate::DATE = DATE '{b.REFERENCE}'",
)
def fn_date_literal(spark, sf_dir):
    day = dates.date_literal(b.REFERENCE)
    rows = b.table(spark, sf_dir, "orders").where(F.to_date("o_orderdate") == day)
    return rows.select("o_orderkey", day.alias("reference_date"))


@query(
    "fn_ds_add",
    "SELECT o_orderkey, (DATE '2001-07-02')::VARCHAR AS source_dir FROM orders"
    " WHERE o_orderdate::DATE >= DATE '2001-06-01'",
)
def fn_ds_add(spark, sf_dir):
    """A run reads the folder of the next day and keeps thirty days."""
    kept = dates.date_literal(dates.ds_add(b.REFERENCE, -30))
    return (
        b.table(spark, sf_dir, "orders")
        .where(F.to_date("o_orderdate") >= kept)
        .select("o_orderkey", F.lit(dates.ds_add(b.REFERENCE, 1).isoformat()).alias("source_dir"))
    )


@query(
    "fn_month_transform",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS created_month FROM orders",
)
def fn_month_transform(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.month_of(F.col("o_orderdate")).alias("created_month")
    )


_EPOCH_SQL = "(1735763400.5 + (doc_id % 60) * 86400)::DOUBLE"


@query(
    "epoch_to_date",
    f"SELECT doc_id, {_EPOCH_SQL} AS created_utc,"
    " DATE '2025-01-01' + (doc_id % 60)::INTEGER AS created_date FROM documents",
)
def epoch_to_date(spark, sf_dir):
    created = (F.lit(1_735_763_400.5) + (F.col("doc_id") % 60) * 86_400).cast("double")
    return b.table(spark, sf_dir, "documents").select(
        "doc_id", created.alias("created_utc"), dates.epoch_to_date(created).alias("created_date")
    )


@query(
    "fn_cast_epoch",
    "SELECT event_id, to_timestamp(user_id * 86400.5 + value)::DATE AS created_date FROM events",
)
def fn_cast_epoch(spark, sf_dir):
    """Epochs with fractions, over many years."""
    seconds = F.col("user_id") * F.lit(86_400.5) + F.col("value")
    return b.table(spark, sf_dir, "events").select(
        "event_id", dates.epoch_to_date(seconds).alias("created_date")
    )


@query(
    "fn_coalesce",
    "SELECT user_id, event_id, COALESCE(CASE user_id % 4 WHEN 0 THEN 'Linux' WHEN 1 THEN 'Darwin'"
    " WHEN 2 THEN 'Windows' END, '') AS system_name FROM events",
)
def fn_coalesce(spark, sf_dir):
    system = b.one_of(F.col("user_id") % 4, "Linux", "Darwin", "Windows")
    return b.table(spark, sf_dir, "events").select(
        "user_id", "event_id", nulls.blank_if_null(system).alias("system_name")
    )


@query(
    "fn_lower_concat_url",
    "SELECT DISTINCT upper(source) AS subreddit_name,"
    " 'https://reddit.com/r/' || lower(source) AS subreddit_url FROM documents",
)
def fn_lower_concat_url(spark, sf_dir):
    named = b.table(spark, sf_dir, "documents").select(F.upper("source").alias("subreddit_name"))
    return with_subreddit_url(named.distinct())


@query(
    "fn_fetch_metadata",
    "SELECT conv_id, turn, '2025-03-05' AS _fetched_date,"
    " '2025-03-05T06:07:08+00:00' AS _fetched_iso_utc FROM conversations",
)
def fn_fetch_metadata(spark, sf_dir):
    rows = b.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return rows.withColumns(dates.fetch_metadata(FETCHED_AT))


# --- decoding ----------------------------------------------------------------

_ROW = T.StructType(
    [
        T.StructField("order_date", T.DateType()),
        T.StructField("order_key", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)
_TYPED = (
    "SELECT o_orderdate::DATE AS order_date, o_orderkey::INTEGER AS order_key,"
    " CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, o_totalprice AS total,"
    " o_orderstatus || '|' || o_orderpriority AS tags FROM orders"
)


def _order_texts(spark, sf_dir):
    """Orders as a query service returns them: every value as text, NULL for
    the status P."""
    status = F.col("o_orderstatus")
    return b.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when(status != "P", status).alias("status"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.concat(F.lit("["), status, F.lit(", "), F.col("o_orderpriority"), F.lit("]")).alias("tags"),
    )


def _flat(df):
    return df.withColumn("tags", F.array_join("tags", "|"))


@query("typed_from_strings", _TYPED)
def typed_from_strings(spark, sf_dir):
    return _flat(decode.typed_from_strings(_order_texts(spark, sf_dir), _ROW))


@query("concat_pages", _TYPED)
def concat_pages(spark, sf_dir):
    """The same rows through pages of text, each with its header."""
    folder = storage.scratch(spark, "pages")
    _order_texts(spark, sf_dir).write.option("header", True).option("escape", '"').csv(folder)
    return _flat(read_pages(spark, folder, _ROW))


@query(
    "fn_split_list",
    "SELECT o_orderkey, len([o_orderstatus, o_orderpriority]) AS n, o_orderpriority AS last FROM orders",
)
def fn_split_list(spark, sf_dir):
    text = F.concat(
        F.lit("["), F.col("o_orderstatus"), F.lit(", "), F.col("o_orderpriority"), F.lit("]")
    )
    tags = decode.split_list(text)
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.size(tags).cast("long").alias("n"), F.element_at(tags, -1).alias("last")
    )


@query(
    "fn_parse_date_int_float",
    "SELECT o_orderdate::DATE AS order_date, o_orderkey::INTEGER AS order_key, o_totalprice AS total"
    " FROM orders",
)
def fn_parse_date_int_float(spark, sf_dir):
    texts = _order_texts(spark, sf_dir)
    typed = {f.name: f.dataType for f in _ROW}
    return texts.select(
        *[decode.decoded(F.col(c), typed[c]).alias(c) for c in ("order_date", "order_key", "total")]
    )


# --- record fields -----------------------------------------------------------

_EDITED = (
    "CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN"
    " (1735763400 + (doc_id % 60) * 86400)::BIGINT::VARCHAR ELSE '1735700000.5' END"
)


def _record(spark, sf_dir, *names):
    """Some fields of the raw submissions, read from files."""
    fields = T.StructType([f for f in SUBMISSION_RECORD if f.name in names])
    folder = f"{storage.scratch(spark, 'raw')}/documents_submissions.json"
    b.write_lines(b.submission_lines(spark, sf_dir), folder)
    return scan_json(spark, [folder], fields)


@query("fn_falsy_to_null", f"SELECT doc_id::VARCHAR AS id, {_EDITED} AS edited FROM documents")
def fn_falsy_to_null(spark, sf_dir):
    record = _record(spark, sf_dir, "id", "edited")
    return record.select("id", nulls.falsy_to_null(F.col("edited")).alias("edited"))


@query(
    "fn_dict_passthrough",
    "SELECT doc_id::VARCHAR AS id, '{\"width\":' || n_chars || '}' AS media,"
    " (doc_id % 4)::INTEGER AS gid_1 FROM documents",
)
def fn_dict_passthrough(spark, sf_dir):
    """An object kept as its text, a map as a map."""
    record = _record(spark, sf_dir, "id", "media", "gildings")
    return record.select("id", "media", F.col("gildings")["gid_1"].alias("gid_1"))
