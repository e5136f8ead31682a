"""Queries over forum content, mentions and their rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks import sql
from checks.registry import query
from tidemark import storage
from tidemark.functions import nulls, terms
from tidemark.functions.bands import band_of
from tidemark.functions.dates import date_literal, ds_add
from tidemark.operators import mentions as m
from tidemark.operators import prefix, rollups, windows
from tidemark.operators.intervals import band_totals, join_bands
from tidemark.operators.scoring import score_mentions
from tidemark.operators.term_table import find_mentions_by_table
from tidemark.sources.dimensions import BANDS, band_rows, project_rows

_LISTED_TEXT = "list_transform(found, lambda m: m.project || ':' || m.mentions::VARCHAR)"


def _as_text(mentions):
    """A mention list as one string: the comparison needs flat columns."""
    return F.array_join(
        F.transform(mentions, lambda x: F.concat(x["project"], F.lit(":"), x["mentions"].cast("string"))),
        ",",
    )


def daily(spark, sf_dir):
    return rollups.reddit_daily(b.scored(spark, sf_dir), BANDS)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 10) for c in columns})


# --- mentions ----------------------------------------------------------------


@query(
    "find_mentions",
    sql.select(
        sql.LISTED,
        "SELECT content_type, id, CASE WHEN len(found) > 0 THEN"
        f" array_to_string({_LISTED_TEXT}, ',') END AS projects_mentions FROM listed",
    ),
)
def find_mentions_(spark, sf_dir):
    return b.mentioned(spark, sf_dir).select(
        "content_type", "id", _as_text(F.col("projects_mentions")).alias("projects_mentions")
    )


@query(
    "find_mentions_term_table",
    sql.select(
        sql.LISTED,
        "SELECT content_type, id, CASE WHEN len(found) > 0 THEN"
        f" array_to_string({_LISTED_TEXT}, ',') END AS projects_mentions FROM listed",
    ),
)
def find_mentions_term_table(spark, sf_dir):
    names = F.array(*[F.lit(p.name) for p in b.PROJECTS])
    projects = project_rows(spark, b.PROJECTS).withColumn("place", F.array_position(names, F.col("project_name")))
    found = find_mentions_by_table(b.content(spark, sf_dir), projects, position="place")
    return found.select("content_type", "id", _as_text(F.col("projects_mentions")).alias("projects_mentions"))


@query(
    "term_table_of_all_words",
    f"""WITH {sql.CONTENT},
words AS (
  SELECT content_type, id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) AS word
  FROM content),
terms AS (
  SELECT DISTINCT word FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) AS word FROM documents)
  WHERE word <> '')
SELECT word AS project, COUNT(DISTINCT (content_type, id)) AS texts, COUNT(*) AS mentions
FROM words JOIN terms USING (word) GROUP BY word""",
)
def term_table_of_all_words(spark, sf_dir):
    """A dictionary that grows with the data: each word of a document is a term."""
    word = F.explode(terms.text_words(F.col("text"))).alias("word")
    words = b.table(spark, sf_dir, "documents").select(word).where("word != ''").distinct()
    projects = words.select(F.col("word").alias("project_name"), F.array("word").alias("project_search_terms"))
    content = b.content(spark, sf_dir)
    found = m.explode_mentions(find_mentions_by_table(content, projects))
    # Ids of one row only need no telling apart: they are counted where they are.
    name = ["content_type", "id"]
    path = storage.scratch(spark, "copied-ids")
    content.groupBy(*name).count().where("count > 1").select(*name, F.lit(True).alias("copied")).write.parquet(path)
    marked = found.join(spark.read.parquet(path), name, "left")
    copied = [F.when(F.col("copied"), F.col(c)) for c in name]
    texts = F.count_if(F.col("copied").isNull()) + F.count_distinct(*copied)
    return marked.groupBy("project").agg(texts.alias("texts"), F.sum("mentions").alias("mentions"))


@query(
    "lateral_unnest",
    sql.select(
        sql.MENTIONS, "SELECT content_type, id, created_date, project, mentions FROM mentions"
    ),
)
def lateral_unnest(spark, sf_dir):
    return m.explode_mentions(b.mentioned(spark, sf_dir).drop("text"))


@query(
    "filter_not_null_array",
    sql.select(
        sql.LISTED, "SELECT content_type, id, created_date FROM listed WHERE len(found) > 0"
    ),
)
def filter_not_null_array(spark, sf_dir):
    found = b.mentioned(spark, sf_dir).where(F.col("projects_mentions").isNotNull())
    return found.select("content_type", "id", "created_date")


@query(
    "fn_regex_count",
    sql.select(
        sql.CONTENT,
        "SELECT content_type, id, "
        + ", ".join(
            f"{sql.term_count(t)} AS {name}"
            for t, name in (("that", "that_count"), ("with this", "with_this_count"), ("of the", "of_the_count"))
        )
        + " FROM content",
    ),
)
def fn_regex_count(spark, sf_dir):
    text = F.col("text")
    return b.content(spark, sf_dir).select(
        "content_type",
        "id",
        terms.term_count(text, "that").alias("that_count"),
        terms.term_count(text, "with this").alias("with_this_count"),
        terms.term_count(text, "of the").alias("of_the_count"),
    )


_TERMS = [t for p in b.PROJECTS for t in p.terms]


@query(
    "fn_term_pattern",
    sql.select(
        sql.CONTENT,
        " UNION ALL ".join(
            f"SELECT '{t}' AS term, COUNT(*) FILTER (WHERE {sql.term_count(t)} > 0) AS texts,"
            f" SUM({sql.term_count(t)})::BIGINT AS matches FROM content"
            for t in _TERMS
        ),
    ),
)
def fn_term_pattern(spark, sf_dir):
    """Texts and matches of every term, in one pass over the texts."""
    text = F.col("text")
    counts = F.array(
        *[
            F.struct(F.lit(t).alias("term"), terms.term_count(text, t).alias("n"))
            for t in _TERMS
        ]
    )
    return (
        b.content(spark, sf_dir)
        .select(F.inline(counts))
        .groupBy("term")
        .agg(F.count_if(F.col("n") > 0).alias("texts"), F.sum("n").alias("matches"))
    )


@query(
    "fn_array_size_null",
    sql.select(
        sql.LISTED,
        "SELECT content_type, id, CASE WHEN len(found) > 0 THEN len(found) END AS projects FROM listed",
    ),
)
def fn_array_size_null(spark, sf_dir):
    """Rows with an empty list get NULL instead."""
    listed = F.coalesce(F.col("projects_mentions"), F.array())
    return b.mentioned(spark, sf_dir).select(
        "content_type", "id", F.size(nulls.empty_to_null(listed)).cast("long").alias("projects")
    )


@query(
    "fn_array_distinct",
    sql.select(
        sql.LISTED,
        "SELECT content_type, id, array_to_string(list_transform(found, lambda m: m.project), ',')"
        " AS projects FROM listed WHERE len(found) > 0",
    ),
)
def fn_array_distinct(spark, sf_dir):
    """Distinct projects of a text, from a list that names each twice."""
    twice = F.concat("projects_mentions", "projects_mentions")
    return (
        b.mentioned(spark, sf_dir)
        .where(F.col("projects_mentions").isNotNull())
        .select("content_type", "id", F.array_join(m.mentioned_projects(twice), ",").alias("projects"))
    )


@query(
    "dim_values",
    sql.select(
        sql.MENTIONS,
        "SELECT p.project_name, p.terms, p.package, p.categories, COUNT(m.id) AS texts FROM (VALUES "
        + ", ".join(
            f"('{p.name}', '{'|'.join(p.terms)}', "
            + (f"'{p.package}'" if p.package else "NULL")
            + f", '{'|'.join(p.categories)}')"
            for p in b.PROJECTS
        )
        + ") AS p(project_name, terms, package, categories) LEFT JOIN mentions m"
        " ON p.project_name = m.project GROUP BY ALL",
    ),
)
def dim_values(spark, sf_dir):
    """Literal dimension rows, lists and NULLs included, with their mentions."""
    texts = (
        m.explode_mentions(b.mentioned(spark, sf_dir))
        .groupBy(F.col("project").alias("project_name"))
        .agg(F.count("*").alias("texts"))
    )
    return (
        project_rows(spark, b.PROJECTS)
        .join(texts, "project_name", "left")
        .select(
            "project_name",
            F.array_join("project_search_terms", "|").alias("terms"),
            F.col("pypi_project_name").alias("package"),
            F.array_join("project_categories", "|").alias("categories"),
            nulls.zero_if_null(F.col("texts")).alias("texts"),
        )
    )


# --- scores ------------------------------------------------------------------

_TEST_SCORE = (
    "((length(text) * 7919 + length(m.project) * 17 + len(found) * 31) % 22001 - 11000)::DOUBLE"
    " / 10000::DOUBLE"
)


@query(
    "score_mentions",
    sql.select(
        sql.LISTED,
        "SELECT content_type, id, m.project AS project,"
        f" m.project || ': ' || length(text)::VARCHAR AS summary, {_TEST_SCORE} AS polarity"
        " FROM (SELECT *, unnest(found) AS m FROM listed)",
    ),
)
def score_mentions_(spark, sf_dir):
    scored = score_mentions(b.mentioned(spark, sf_dir), b.example_scorer())
    return scored.select("content_type", "id", F.inline("projects_mentions_polarity"))


@query(
    "when_guard",
    sql.select(
        sql.LISTED,
        "SELECT content_type, id, CASE WHEN len(found) > 0 THEN len(found) END AS scores FROM listed",
    ),
)
def when_guard(spark, sf_dir):
    """Scores only where something is mentioned, NULL elsewhere."""
    scored = score_mentions(b.mentioned(spark, sf_dir), b.example_scorer())
    found = F.col("projects_mentions_polarity")
    return scored.select(
        "content_type", "id", F.when(found.isNotNull(), F.size(found)).cast("long").alias("scores")
    )


@query(
    "range_join_polarity_band",
    sql.select(
        sql.SCORED, "SELECT content_type, id, project, polarity, polarity_category FROM banded"
    ),
)
def range_join_polarity_band(spark, sf_dir):
    scores = b.scored(spark, sf_dir).select(
        "content_type", "id", F.inline("projects_mentions_polarity")
    )
    return scores.select(
        "content_type",
        "id",
        "project",
        "polarity",
        band_of(F.col("polarity"), BANDS).alias("polarity_category"),
    )


@query(
    "range_join_band_table",
    sql.select(
        sql.SCORED, "SELECT content_type, id, project, polarity, polarity_category FROM banded"
    ),
)
def range_join_band_table(spark, sf_dir):
    """The same with the bands as a table of unknown size."""
    scores = b.scored(spark, sf_dir).select(
        "content_type", "id", F.inline("projects_mentions_polarity")
    )
    return join_bands(scores.drop("summary"), "polarity", band_rows(spark))


_BANDS_OF_PRICES = """bands AS (
  SELECT p_partkey AS polarity_category, p_retailprice - p_size AS polarity_lower_bound,
    p_retailprice + p_size * p_size AS polarity_upper_bound FROM part)"""


@query(
    "range_join_many_bands",
    sql.select(
        _BANDS_OF_PRICES,
        "SELECT l_orderkey, l_linenumber, COUNT(polarity_category) AS n_bands, SUM(polarity_category)::BIGINT AS band_keys"
        " FROM lineitem LEFT JOIN bands ON l_extendedprice / l_quantity BETWEEN polarity_lower_bound AND polarity_upper_bound"
        " GROUP BY ALL",
    ),
)
def range_join_many_bands(spark, sf_dir):
    """A band for each part around its price, and how many hold the unit price
    of each line. One price is in thousands of bands, so pairs are not built."""
    size, price = F.col("p_size"), F.col("p_retailprice")
    bands = b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("polarity_category"),
        (price - size).alias("polarity_lower_bound"),
        (price + size * size).alias("polarity_upper_bound"),
    )
    lines = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price")
    )
    return (
        band_totals(lines, "unit_price", bands)
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.sum("band_count").alias("n_bands"), F.sum("band_sum").alias("band_keys"))
    )


# --- rollups -----------------------------------------------------------------


@query(
    "join_inner_mentions_polarity",
    sql.select(
        sql.SCORED,
        "SELECT m.created_date, m.id, m.project, p.polarity_category, SUM(m.mentions)::BIGINT AS"
        " mentions_count, COUNT(*) AS pairs, round(SUM(p.polarity), 8) AS polarity_sum FROM mentions m"
        " JOIN banded p ON m.created_date = p.created_date AND m.id = p.id AND m.project = p.project"
        " GROUP BY ALL",
    ),
)
def join_inner_mentions_polarity(spark, sf_dir):
    pairs = rollups.join_mentions_polarity(b.scored(spark, sf_dir), BANDS).drop("scored_pairs")
    return pairs.withColumn("polarity_sum", F.round("polarity_sum", 8))


@query(
    "reddit_daily",
    sql.select(sql.DAILY, "SELECT * REPLACE (round(avg_polarity, 10) AS avg_polarity) FROM daily"),
)
def reddit_daily_(spark, sf_dir):
    return _rounded(daily(spark, sf_dir), "avg_polarity")


def _register_window_sums() -> None:
    for days in (*windows.WINDOWS, windows.ALL_TIME):
        condition = sql.in_window("created_date", b.MENTION_REFERENCE, days)
        body = (
            "SELECT project, polarity_category, SUM(mentions_count)::BIGINT AS mentions_count,"
            f" round(AVG(avg_polarity), 10) AS avg_polarity FROM daily WHERE {condition} GROUP BY 1, 2"
        )

        def run(spark, sf_dir, days=days):
            rows = windows.window_sum_avg(daily(spark, sf_dir), b.MENTION_REFERENCE, days)
            return _rounded(rows, "avg_polarity")

        query(f"agg_window_sum_avg_{days or 'all'}", sql.select(sql.DAILY, body))(run)


_register_window_sums()


def _averages(df):
    return [c for c in df.columns if c.startswith("avg_")]


_CUMULATIVE = sql.select(
    f"{sql.DAILY}, {sql.PROJECT_VALUES}, {sql.left_join_star(b.MENTION_REFERENCE)}",
    "SELECT * FROM star",
)


@query("reddit_cumulative", _CUMULATIVE)
def reddit_cumulative_(spark, sf_dir):
    projects = project_rows(spark, b.PROJECTS)
    rollup = rollups.reddit_cumulative(
        daily(spark, sf_dir), projects, BANDS, b.MENTION_REFERENCE
    )
    return _rounded(rollup, *_averages(rollup))


_DAILY_CONTENT = """daily AS (
  SELECT DATE '2025-01-01' + (doc_id % 60)::INTEGER AS created_date, source AS project,
    CASE lang WHEN 'en' THEN 'Positive' WHEN 'fr' THEN 'Negative' WHEN 'de' THEN 'Neutral' END
      AS polarity_category,
    COUNT(*) AS mentions_count, AVG(n_chars % 100 / 100::DOUBLE) AS avg_polarity
  FROM documents GROUP BY ALL)"""
_SOURCES = "projects AS (SELECT DISTINCT source AS project_name FROM documents)"


def _daily_by_source(spark, sf_dir):
    """A daily rollup straight from ``documents``: a project per source, a
    band per language, and one language without."""
    lang = F.col("lang")
    band = (
        F.when(lang == "en", "Positive").when(lang == "fr", "Negative").when(lang == "de", "Neutral")
    )
    return (
        b.table(spark, sf_dir, "documents")
        .groupBy(
            b.content_day(F.col("doc_id")).alias("created_date"),
            F.col("source").alias("project"),
            band.alias("polarity_category"),
        )
        .agg(
            F.count("*").alias("mentions_count"),
            F.avg(F.col("n_chars") % 100 / F.lit(100.0)).alias("avg_polarity"),
        )
    )


def _sources(spark, sf_dir):
    return b.table(spark, sf_dir, "documents").select(F.col("source").alias("project_name")).distinct()


@query(
    "join_left_star",
    sql.select(
        f"{_DAILY_CONTENT}, {sql.BANDS}, {_SOURCES}, {sql.left_join_star(b.MENTION_REFERENCE)}",
        "SELECT * FROM star",
    ),
)
def join_left_star(spark, sf_dir):
    """Spine and six window aggregates, for projects out of the data."""
    rollup = rollups.reddit_cumulative(
        _daily_by_source(spark, sf_dir), _sources(spark, sf_dir), BANDS, b.MENTION_REFERENCE
    )
    return _rounded(rollup, *_averages(rollup))


_UNTIL = f"WHERE DATE '2025-01-01' + (doc_id % 60)::INTEGER <= DATE '{b.MENTION_REFERENCE}'"


@query(
    "reddit_cumulative_prefix",
    sql.select(
        f"{_DAILY_CONTENT.replace('FROM documents', f'FROM documents {_UNTIL}')}, {sql.BANDS}, {_SOURCES},"
        f" {sql.left_join_star(b.MENTION_REFERENCE)}",
        "SELECT * FROM star",
    ),
)
def reddit_cumulative_prefix(spark, sf_dir):
    """All windows as differences of running sums, those of the last day built
    on the day before."""
    sums = prefix.mention_sums(_daily_by_source(spark, sf_dir))
    before = ds_add(b.MENTION_REFERENCE, -1)
    rows = prefix.prefix_rows(
        sums, "created_date", prefix.MENTION_KEYS, prefix.MENTION_SUMS, ds_add(b.MENTION_REFERENCE, -365), before
    )
    fresh = sums.where(F.col("created_date") == date_literal(b.MENTION_REFERENCE))
    last = prefix.prefix_rows(
        fresh, "created_date", prefix.MENTION_KEYS, prefix.MENTION_SUMS, b.MENTION_REFERENCE, b.MENTION_REFERENCE,
        rows.where(F.col(prefix.DAY) == date_literal(before)),
    )
    rollup = prefix.mentions_from_prefix(rows.unionByName(last), _sources(spark, sf_dir), BANDS, b.MENTION_REFERENCE)
    return _rounded(rollup, *_averages(rollup))


@query(
    "cross_join_spine",
    sql.select(
        f"{sql.BANDS}, {_SOURCES}",
        "SELECT project_name AS project, polarity_category FROM projects CROSS JOIN bands",
    ),
)
def cross_join_spine(spark, sf_dir):
    return rollups.spine(_sources(spark, sf_dir), BANDS)
