"""The queries of this package: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import balls, bpe, fingerprints, language, licenses, lines, mixing, near, phrases, quality, repair, repeats, tokens
from tidemark.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256).alias("kept_sha256")
    )


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(documents(spark, sf_dir), keep=("doc_id",))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs, language.not_held_out())
    held_out = ~language.not_held_out()
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query("op9_near_dedup")
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near.near_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return groups.select("doc_id", F.col("lead_doc_id").alias("class_id"))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.filtered(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licensed(documents(spark, sf_dir))


@query("op10_token_planes")
def op10_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return tokens.token_table(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(documents(spark, sf_dir))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(documents(spark, sf_dir))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op11_collocations",
    r"""
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents
    ), cut as (
        select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
    ), starts as (
        select lang, w, unnest(range(1, len(w) + 1)) as i from cut
    ), grams as (
        select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase, count(*) as f
        from starts, (values (1), (2), (3), (4)) as sizes(size)
        where i + size - 1 <= len(w) group by all
    ), totals as (
        select lang, cast(sum(f) as bigint) as n from grams where size = 1 group by lang
    ), found as (
        select lang, size, phrase, f as a, string_split(phrase, ' ') as w from grams where size > 1 and f >= 30
    ), cuts as (
        select lang, phrase, size, a, w, unnest(range(1, size)) as cut from found
    ), scored as (
        select c.lang, c.phrase, c.a, x.f as l, y.f as r, c.cut,
            cast((2000000::hugeint * c.a) // (x.f::hugeint + y.f) as bigint) as score
        from cuts c
        join grams x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.cut], ' ')
        join grams y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.cut + 1:c.size], ' ')
    ), judged as (
        select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1
    ), inner_lengths as (
        select lang, size, a, w, unnest(range(2, size)) as length from found where size > 2
    ), inner_starts as (
        select lang, a, w, length, unnest(range(1, size - length + 2)) as i from inner_lengths
    ), longer as (
        select lang, array_to_string(w[i:i + length - 1], ' ') as phrase, max(a) as f from inner_starts group by all
    )
    select j.lang, row_number() over (partition by j.lang order by j.score desc, j.a desc, j.phrase) as rank,
        j.phrase, j.a, j.l, j.r, t.n, j.score
    from judged j join totals t on t.lang = j.lang
    left join longer g on g.lang = j.lang and g.phrase = j.phrase
    where g.f is null or 100::hugeint * g.f < 80::hugeint * j.a
    qualify rank <= 2000
    """,
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


@query("op12_ball_dedup")
def op12_ball_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balls.near_components(documents(spark, sf_dir))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damaged_and_repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
