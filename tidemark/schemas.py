"""Every table of the lakehouse: columns, keys and directory layout.

Column names and types are fixed values: readers, sinks and users of the
tables depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

_BOOL, _INT, _DOUBLE, _STR, _DATE = (
    T.BooleanType(),
    T.IntegerType(),
    T.DoubleType(),
    T.StringType(),
    T.DateType(),
)
_STRINGS = T.ArrayType(_STR)
_COUNTS = T.MapType(_STR, _INT)


def _struct(*groups: tuple[str, T.DataType]) -> T.StructType:
    """A schema from (space separated names, type) groups, all nullable."""
    return T.StructType(
        [T.StructField(name, dtype, True) for names, dtype in groups for name in names.split()]
    )


@dataclass(frozen=True)
class Table:
    """A Parquet dataset partitioned by at most one column.

    ``partition_sql`` is set when the directory column is computed from the
    row (a month, say) instead of being one of its columns.
    """

    name: str
    schema: T.StructType
    partition: str | None = None
    partition_sql: str | None = None
    keys: tuple[str, ...] = ()
    # How rows lie in a file.
    sort: tuple[str, ...] = ()

    @property
    def stored_schema(self) -> T.StructType:
        if self.partition_sql is None:
            return self.schema
        return T.StructType([*self.schema.fields, T.StructField(self.partition, _STR, True)])

    def widened(self) -> Table:
        """The same table with 64-bit counts, for sums that outgrow INT."""
        fields = [
            T.StructField(f.name, T.LongType() if f.dataType == _INT else f.dataType, True)
            for f in self.schema
        ]
        return replace(self, schema=T.StructType(fields))


# --- downloads ---------------------------------------------------------------

RAW_DOWNLOAD_EVENTS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("project", _STR),
        T.StructField("file", _struct(("version", _STR))),
        T.StructField(
            "details",
            T.StructType(
                [
                    T.StructField("python", _STR),
                    T.StructField("system", _struct(("name", _STR))),
                ]
            ),
        ),
        T.StructField("country_code", _STR),
    ]
)

DOWNLOAD_KEYS = (
    "download_date",
    "project",
    "project_version",
    "python",
    "system_name",
    "country_code",
)
DOWNLOADS = Table(
    "pypi_file_downloads",
    _struct(
        ("download_date", _DATE),
        ("project project_version python system_name country_code", _STR),
        ("download_count", _INT),
    ),
    partition="download_date",
    keys=DOWNLOAD_KEYS,
)
STAGED_DOWNLOADS = replace(DOWNLOADS, name="stg_pypi_file_downloads")


def quarantine_of(table: Table) -> Table:
    """Where the invalid rows of a table are kept, by the run that found them."""
    return Table(
        f"{table.name}_invalid",
        T.StructType([*table.schema.fields, T.StructField("run_date", _DATE)]),
        partition="run_date",
    )


INVALID_DOWNLOADS = quarantine_of(DOWNLOADS)

CUMULATIVE_KEYS = ("project", "project_version", "country_code")
CUMULATIVE_DOWNLOADS = Table(
    "agg_pypi_cumulative_file_downloads",
    _struct(
        ("reference_date", _DATE),
        ("project project_version country_code", _STR),
        (
            "download_count download_count_last_7_days download_count_last_30_days"
            " download_count_last_90_days download_count_last_365_days"
            " download_count_since_first_record",
            _INT,
        ),
    ),
    partition="reference_date",
)
DAILY_PROJECT_DOWNLOADS = Table(
    "agg_pypi_daily_file_downloads",
    _struct(("download_date", _DATE), ("project", _STR), ("download_count", _INT)),
)

# --- forum content -----------------------------------------------------------

# The columns of both tables in their declared order.
_SUBMISSION_COLUMNS = _struct(
    ("archived", _BOOL),
    ("author_fullname", _STR),
    ("author_flair_css_class", _STR),
    ("author_flair_text", _STR),
    ("category", _STR),
    ("clicked", _BOOL),
    ("created", _DOUBLE),
    ("created_utc", _DOUBLE),
    ("created_date", _DATE),
    ("distinguished", _STR),
    ("domain", _STR),
    ("downs", _INT),
    ("edited", _STR),
    ("gilded", _INT),
    ("gildings", _COUNTS),
    ("hidden", _BOOL),
    ("hide_score", _BOOL),
    ("id", _STR),
    ("is_created_from_ads_ui", _BOOL),
    ("is_meta", _BOOL),
    ("is_original_content", _BOOL),
    ("is_reddit_media_domain", _BOOL),
    ("is_self", _BOOL),
    ("is_video", _BOOL),
    ("link_flair_css_class", _STR),
    ("link_flair_text", _STR),
    ("locked", _BOOL),
    ("media", _STR),
    ("media_embed", _STR),
    ("media_only", _BOOL),
    ("name", _STR),
    ("no_follow", _BOOL),
    ("num_comments", _INT),
    ("num_crossposts", _INT),
    ("over_18", _BOOL),
    ("parent_whitelist_status", _STR),
    ("permalink", _STR),
    ("pinned", _BOOL),
    ("pwls", _INT),
    ("quarantine", _BOOL),
    ("removed_by_category", _STR),
    ("saved", _BOOL),
    ("score", _INT),
    ("secure_media", _STR),
    ("selftext", _STR),
    ("selftext_html", _STR),
    ("send_replies", _BOOL),
    ("spoiler", _BOOL),
    ("stickied", _BOOL),
    ("subreddit_id", _STR),
    ("subreddit_name_prefixed", _STR),
    ("subreddit_subscribers", _INT),
    ("subreddit_type", _STR),
    ("thumbnail", _STR),
    ("title", _STR),
    ("total_awards_received", _INT),
    ("treatment_tags", _STRINGS),
    ("ups", _INT),
    ("upvote_ratio", _DOUBLE),
    ("url", _STR),
    ("user_reports", _STRINGS),
    ("whitelist_status", _STR),
    ("wls", _INT),
    ("_fetched_date", _STR),
    ("_fetched_iso_utc", _STR),
)
_COMMENT_COLUMNS = _struct(
    ("archived", _BOOL),
    ("author_fullname", _STR),
    ("author_flair_css_class", _STR),
    ("author_flair_text", _STR),
    ("awarders", _STRINGS),
    ("body", _STR),
    ("body_html", _STR),
    ("collapsed", _BOOL),
    ("collapsed_reason", _STR),
    ("collapsed_reason_code", _STR),
    ("controversiality", _INT),
    ("created_utc", _DOUBLE),
    ("created_date", _DATE),
    ("distinguished", _STR),
    ("downs", _INT),
    ("edited", _STR),
    ("gilded", _INT),
    ("gildings", _COUNTS),
    ("id", _STR),
    ("is_submitter", _BOOL),
    ("link_id", _STR),
    ("locked", _BOOL),
    ("name", _STR),
    ("no_follow", _BOOL),
    ("parent_id", _STR),
    ("permalink", _STR),
    ("score", _INT),
    ("score_hidden", _BOOL),
    ("send_replies", _BOOL),
    ("stickied", _BOOL),
    ("subreddit_id", _STR),
    ("subreddit_name_prefixed", _STR),
    ("subreddit_type", _STR),
    ("total_awards_received", _INT),
    ("treatment_tags", _STRINGS),
    ("ups", _INT),
    ("_fetched_date", _STR),
    ("_fetched_iso_utc", _STR),
)
LEGACY_COLUMNS = ("parent_whitelist_status", "whitelist_status")


def _record(columns: T.StructType) -> T.StructType:
    """What a raw record of a table holds: the table adds a date and two
    columns that records no longer have."""
    return T.StructType([f for f in columns if f.name not in (*LEGACY_COLUMNS, "created_date")])


SUBMISSION_RECORD = _record(_SUBMISSION_COLUMNS)
COMMENT_RECORD = _record(_COMMENT_COLUMNS)

# Fields that must be present and not null in a raw record.
REQUIRED_SUBMISSION = (
    "archived created created_utc downs edited gilded id is_self is_video locked media_only"
    " name num_comments permalink pinned pwls quarantine score selftext stickied"
    " subreddit_id subreddit_name_prefixed subreddit_subscribers title ups upvote_ratio url"
).split()
REQUIRED_COMMENT = (
    "archived body created_utc downs edited gilded id link_id parent_id permalink score"
    " stickied subreddit_id subreddit_name_prefixed ups"
).split()
# JSON objects that the tables keep as text.
OBJECT_TEXT_FIELDS = ("media", "media_embed", "secure_media")
# The one field that a raw record may leave out.
MAY_BE_ABSENT = ("author_fullname",)
FETCH_FIELDS = ("_fetched_date", "_fetched_iso_utc")

_MONTH = "date_format(created_date, 'yyyy-MM')"
SUBMISSIONS = Table(
    "reddit_submissions",
    _SUBMISSION_COLUMNS,
    partition="created_month",
    partition_sql=_MONTH,
    keys=("id",),
    sort=("created_date", "id"),
)
COMMENTS = Table(
    "reddit_comments",
    _COMMENT_COLUMNS,
    partition="created_month",
    partition_sql=_MONTH,
    keys=("id",),
    sort=("created_date", "id"),
)

# --- mentions and their rollups ----------------------------------------------

MENTIONS_TYPE = T.ArrayType(_struct(("project", _STR), ("mentions", _INT)))
POLARITY_TYPE = T.ArrayType(_struct(("project summary", _STR), ("polarity", _DOUBLE)))
MENTIONS = Table(
    "reddit_projects_mentions",
    _struct(
        ("content_type", _STR),
        ("created_utc", _DOUBLE),
        ("created_date", _DATE),
        ("title id subreddit text permalink", _STR),
        ("score", _INT),
        ("projects_mentions", MENTIONS_TYPE),
        ("projects_mentions_polarity", POLARITY_TYPE),
    ),
    partition="created_date",
)
# What a scorer gave for a text and its projects.
SCORES = Table(
    "content_scores",
    T.StructType(
        [
            T.StructField("content_key", T.BinaryType()),
            T.StructField("scores", POLARITY_TYPE),
            T.StructField("version", _STR),
        ]
    ),
    partition="version",
    keys=("version", "content_key"),
)
DAILY_MENTIONS = Table(
    "agg_reddit_daily_mentions_polarity",
    _struct(
        ("created_date", _DATE),
        ("project polarity_category", _STR),
        ("mentions_count", _INT),
        ("avg_polarity", _DOUBLE),
    ),
    partition="created_date",
)
WINDOW_SUFFIXES = (
    "",
    "_last_7_days",
    "_last_30_days",
    "_last_90_days",
    "_last_365_days",
    "_since_first_record",
)
CUMULATIVE_MENTIONS = Table(
    "agg_reddit_cumulative_mentions_polarity",
    _struct(
        ("reference_date", _DATE),
        ("project polarity_category", _STR),
        *(
            group
            for suffix in WINDOW_SUFFIXES
            for group in ((f"mentions_count{suffix}", _INT), (f"avg_polarity{suffix}", _DOUBLE))
        ),
    ),
    partition="reference_date",
)

# --- dimensions --------------------------------------------------------------

TRACKED_SUBREDDITS = Table("dim_tracked_subreddits", _struct(("subreddit_name subreddit_url", _STR)))
TRACKED_PROJECTS = Table(
    "dim_tracked_projects",
    _struct(
        ("project_name", _STR),
        ("project_search_terms", _STRINGS),
        ("pypi_project_name", _STR),
        ("project_categories", _STRINGS),
    ),
)
POLARITY_CATEGORIES = Table(
    "dim_polarity_categories",
    _struct(
        ("polarity_category", _STR),
        ("polarity_category_order", _INT),
        ("polarity_lower_bound polarity_upper_bound", _DOUBLE),
    ),
)

ALL_TABLES = (
    DOWNLOADS,
    STAGED_DOWNLOADS,
    INVALID_DOWNLOADS,
    CUMULATIVE_DOWNLOADS,
    DAILY_PROJECT_DOWNLOADS,
    SUBMISSIONS,
    COMMENTS,
    MENTIONS,
    DAILY_MENTIONS,
    CUMULATIVE_MENTIONS,
    TRACKED_SUBREDDITS,
    TRACKED_PROJECTS,
    POLARITY_CATEGORIES,
)
