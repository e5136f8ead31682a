"""The bindings once more, as SQL common table expressions, and the queries of
several checks in their long, literal form."""

from __future__ import annotations

from checks.bindings import PROJECTS, REFERENCE

# Look-up values of the bindings.
EVENTS = """ev AS (
  SELECT event_id, ts, event_type AS project,
    json_extract_string(props, '$.k') AS project_version,
    '3.' || (user_id % 5 + 8)::VARCHAR AS python,
    CASE user_id % 4 WHEN 0 THEN 'Linux' WHEN 1 THEN 'Darwin' WHEN 2 THEN 'Windows' END AS system_name,
    CASE user_id % 7 WHEN 0 THEN 'US' WHEN 1 THEN 'BR' WHEN 2 THEN 'DE' WHEN 3 THEN 'IN'
      WHEN 4 THEN 'JP' WHEN 5 THEN 'zz' END AS country_code
  FROM events)"""
KEYS = "download_date, project, project_version, python, system_name, country_code"
EVENT_DOWNLOADS = f"""{EVENTS},
evd AS (
  SELECT ts::DATE AS download_date, project, project_version, python, system_name, country_code,
    COUNT(project) AS download_count
  FROM ev GROUP BY ALL)"""

DOWNLOAD_ROWS = """dl_rows AS (
  SELECT o_orderdate::DATE AS download_date, p_brand AS project, p_type AS project_version,
    l_linestatus AS python, l_returnflag AS system_name,
    CASE WHEN c_nationkey = 24 THEN NULL WHEN c_nationkey = 23 THEN 'xx'
      ELSE chr(65 + c_nationkey) || chr(65 + n_regionkey) END AS country_code,
    l_quantity::BIGINT AS download_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
DOWNLOADS = f"""{DOWNLOAD_ROWS},
dl AS (
  SELECT {KEYS}, SUM(download_count)::BIGINT AS download_count FROM dl_rows GROUP BY ALL)"""

STAGED = """staged AS (
  SELECT l_shipdate::DATE AS download_date, l_suppkey::VARCHAR AS project,
    CASE WHEN l_linenumber < 7 THEN l_linenumber::VARCHAR END AS project_version,
    l_linestatus AS python, l_returnflag AS system_name,
    CASE l_suppkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'us' WHEN 2 THEN 'BRA' WHEN 3 THEN 'DE' END
      AS country_code,
    (l_quantity - 2)::INTEGER AS download_count
  FROM lineitem)"""
RULES = {
    "null_values": "(download_date IS NULL OR project IS NULL OR project_version IS NULL"
    " OR download_count IS NULL)",
    "download_counts": "download_count <= 0",
    "country_codes": "NOT regexp_matches(country_code, '^[A-Z]{2}$')",
}

BRANDS = """brands AS (
  SELECT p_brand AS project_name, lower(p_brand) AS term,
    CASE WHEN length(p_brand) > 7 THEN p_brand END AS pypi_project_name,
    list_sort(list(DISTINCT p_type)) AS project_categories
  FROM part GROUP BY p_brand)"""
BRAND_CATEGORIES = f"""{BRANDS},
categories AS (
  SELECT pypi_project_name AS project, unnest(project_categories) AS category
  FROM brands WHERE pypi_project_name IS NOT NULL)"""

# --- content -----------------------------------------------------------------

_PATTERNS = {
    "that": r"that",
    "with": r"with",
    "with this": r"with[-\s]?this",
    "of the": r"of[-\s]?the",
    "from": r"from",
    "Is": r"is",
    "the": r"the",
    "Evidence.dev": r"evidence\.dev",
}


def term_count(term: str) -> str:
    return rf"len(regexp_extract_all(text, '(?i)\b{_PATTERNS[term]}\b'))"


def _entries() -> str:
    return ", ".join(
        f"{{'project': '{p.name}', 'mentions': {' + '.join(map(term_count, p.terms))}}}"
        for p in PROJECTS
    )


CONTENT = """content AS (
  SELECT 'submission' AS content_type, doc_id::VARCHAR AS id,
    DATE '2025-01-01' + (doc_id % 60)::INTEGER AS created_date, text FROM documents
  UNION ALL
  SELECT 'comment', (conv_id * 100 + turn)::VARCHAR,
    DATE '2025-01-01' + (conv_id % 60)::INTEGER, text FROM conversations)"""
LISTED = f"""{CONTENT},
listed AS (
  SELECT content_type, id, created_date, text,
    list_filter([{_entries()}], lambda m: m.mentions > 0) AS found
  FROM content)"""
MENTIONS = f"""{LISTED},
mentions AS (
  SELECT content_type, id, created_date, text, m.project AS project, m.mentions::INTEGER AS mentions
  FROM (SELECT * EXCLUDE (found), unnest(found) AS m FROM listed))"""
BANDS = """bands AS (
  SELECT * FROM (VALUES ('Very Negative', -1.0::DOUBLE, -0.6::DOUBLE),
    ('Negative', -0.599::DOUBLE, -0.2::DOUBLE), ('Neutral', -0.199::DOUBLE, 0.199::DOUBLE),
    ('Positive', 0.2::DOUBLE, 0.599::DOUBLE), ('Very Positive', 0.6::DOUBLE, 1.0::DOUBLE))
  AS b(polarity_category, lo, hi))"""
POLARITY = (
    "((length(text) * 7919 + length(project) * 17 + mentions * 31) % 22001 - 11000)::DOUBLE"
    " / 10000::DOUBLE"
)
SCORED = f"""{MENTIONS}, {BANDS},
scored AS (
  SELECT m.*, {POLARITY} AS polarity FROM mentions m),
banded AS (
  SELECT s.*, b.polarity_category FROM scored s LEFT JOIN bands b ON s.polarity BETWEEN b.lo AND b.hi)"""
DAILY = f"""{SCORED},
daily AS (
  SELECT m.created_date, m.project, p.polarity_category,
    SUM(m.mentions)::BIGINT AS mentions_count, AVG(p.polarity) AS avg_polarity
  FROM mentions m JOIN banded p
    ON m.created_date = p.created_date AND m.id = p.id AND m.project = p.project
  GROUP BY ALL)"""
PROJECT_VALUES = (
    "projects AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{p.name}')" for p in PROJECTS)
    + ") AS p(project_name))"
)

# --- rollups, literally --------------------------------------------------------

WINDOWS = (1, 7, 30, 90, 365, None)


def suffix(days: int | None) -> str:
    return "_since_first_record" if days is None else "" if days == 1 else f"_last_{days}_days"


def in_window(column: str, reference: str, days: int | None) -> str:
    if days is None:
        return "TRUE"
    return f"{column} BETWEEN DATE '{reference}' - {days - 1} AND DATE '{reference}'"


def right_join_chain(source: str, reference: str = REFERENCE) -> str:
    """Six aggregates over six scans, joined by five right joins."""
    names = [f"w{d or 'all'}" for d in WINDOWS]
    ctes = ",\n".join(
        f"{n} AS (SELECT project, project_version, country_code,"
        f" SUM(download_count)::BIGINT AS download_count FROM {source}"
        f" WHERE {in_window('download_date', reference, d)}"
        " GROUP BY project, project_version, country_code)"
        for n, d in zip(names, WINDOWS)
    )
    joins = " ".join(
        f"RIGHT JOIN {b} ON {a}.project = {b}.project"
        f" AND {a}.project_version = {b}.project_version AND {a}.country_code = {b}.country_code"
        for a, b in zip(names, names[1:])
    )
    keys = ", ".join(
        f"COALESCE({', '.join(f'{n}.{k}' for n in names)}) AS {k}"
        for k in ("project", "project_version", "country_code")
    )
    sums = ", ".join(
        f"COALESCE({n}.download_count, 0) AS download_count{suffix(d)}"
        for n, d in zip(names[:-1], WINDOWS)
    )
    return (
        f"{ctes},\nchain AS (SELECT DATE '{reference}' AS reference_date, {keys}, {sums},"
        f" wall.download_count AS download_count_since_first_record FROM w1 {joins})"
    )


def left_join_star(reference: str, source: str = "daily") -> str:
    """Six aggregates over six scans, left-joined to the dense spine."""
    names = [f"w{d or 'all'}" for d in WINDOWS]
    ctes = ",\n".join(
        f"{n} AS (SELECT project, polarity_category, SUM(mentions_count)::BIGINT AS mentions_count,"
        f" AVG(avg_polarity) AS avg_polarity FROM {source}"
        f" WHERE {in_window('created_date', reference, d)} GROUP BY project, polarity_category)"
        for n, d in zip(names, WINDOWS)
    )
    joins = " ".join(
        f"LEFT JOIN {n} ON p.project_name = {n}.project"
        f" AND c.polarity_category = {n}.polarity_category"
        for n in names
    )
    values = ", ".join(
        f"COALESCE({n}.mentions_count, 0) AS mentions_count{suffix(d)},"
        f" round(COALESCE({n}.avg_polarity, 0), 10) AS avg_polarity{suffix(d)}"
        for n, d in zip(names, WINDOWS)
    )
    return (
        f"{ctes},\nstar AS (SELECT DATE '{reference}' AS reference_date, p.project_name AS project,"
        f" c.polarity_category, {values} FROM projects p CROSS JOIN bands c {joins})"
    )


def select(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"
