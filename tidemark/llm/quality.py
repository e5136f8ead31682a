"""Quality of documents by weak supervision, on DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, saved, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
THRESHOLD = 0.5
ROUNDS = 40
_SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """Votes good (1) or bad (-1) on a document's measures, or abstains."""

    name: str
    bad: Callable[[], Column]
    good: Callable[[], Column]

    def vote(self) -> Column:
        return F.when(self.bad(), -1).when(self.good(), 1).otherwise(0)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


RULES = (
    Rule("symbols", lambda: _share("n_symbols", "word_chars") > 0.05, lambda: _share("n_symbols", "word_chars") < 0.01),
    Rule("letters_digits", lambda: _share("n_alnum", "word_chars") < 0.88, lambda: _share("n_alnum", "word_chars") >= 0.92),
    Rule("bare_marks", lambda: _share("n_marks", "n_words") > 0.1, lambda: _share("n_marks", "n_words") < 0.03),
    Rule("word_length", lambda: ~_share("word_chars", "n_words").between(2, 12), lambda: _share("word_chars", "n_words").between(3, 7)),
    Rule("repeats", lambda: _share("n_repeat_words", "n_words") > 0.3, lambda: F.col("n_repeat_words") == 0),
    Rule("equal_lines", lambda: _share("n_dup_lines", "n_lines") > 0.3, lambda: F.col("n_dup_lines") == 0),
    Rule("variety", lambda: _share("n_distinct", "n_words") < 0.3, lambda: _share("n_distinct", "n_words") >= 0.6),
    Rule("length", lambda: F.col("n_words") < 20, lambda: F.col("n_words") >= 60),
)


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """How many words lie in runs of ``window`` words that occur twice or more;
    words come as hashes."""
    n = F.size(hashes)
    runs = F.when(n < window, F.array().cast("array<long>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1))),
            lambda i: F.xxhash64(F.slice(hashes, i, F.lit(window))),
        )
    )

    def covered(run: Column) -> Column:
        ordered = F.sort_array(F.transform(run, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return let(ordered, spread)

    def spread(ordered: Column) -> Column:
        several = F.filter(
            F.transform(
                ordered,
                lambda e, k: F.when(
                    (e["x"] == F.get(ordered, k - 1)["x"]) | (e["x"] == F.get(ordered, k + 1)["x"]), e["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        )
        start = F.struct(F.lit(-window).alias("at"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(
            F.sort_array(several),
            start,
            lambda s, i: F.struct(
                i.alias("at"), (s["total"] + F.least(F.lit(window), i - s["at"])).cast("long").alias("total")
            ),
            lambda s: s["total"],
        )

    zero = F.lit(0).cast("long")
    return let(runs, lambda run: F.when(F.size(F.array_distinct(run)) == F.size(run), zero).otherwise(covered(run)))


def measured(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns and a document's measures. A NULL text has none of
    anything."""
    text = F.col("__text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.select(*names, F.coalesce("text", F.lit("")).alias("__text"))
        .withColumn("__hashes", F.transform(words(text), lambda w: F.xxhash64(w)))
        .withColumn("__lines", lines)
        .select(
            *names,
            F.size("__hashes").cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, _SPACE, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size("__lines").cast("long").alias("n_lines"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("__hashes")).alias("n_repeat_words"),
            F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")).cast("long").alias("n_alnum"),
            F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])"))
            .cast("long")
            .alias("n_marks"),
            F.size(F.array_distinct("__hashes")).cast("long").alias("n_distinct"),
        )
    )


def learn_accuracies(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> DataFrame:
    """One row (prior, on_good, on_bad) from (votes, n): the share of good
    documents, and for each rule how often it is right when it votes on a good
    and on a bad one, by expectation-maximisation.

    Nothing is labelled. Given the accuracies, Bayes' rule tells for each
    pattern of votes how probably it is good; given those, accuracies and prior
    are weighted shares. Two accuracies for each rule are needed: a rule that
    nearly always votes good is nearly always right on good documents, and
    still tells nothing. It starts from rules that are right four times in
    five. No rule is taken to be worse than chance, so that good remains good.
    There are 3^rules patterns at most, so that all of this is one small row
    whatever the number of documents.
    """
    one = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("p"))
    every = F.sequence(F.lit(0), F.lit(n_rules - 1))
    four_in_five = F.array(*[F.lit(0.8)] * n_rules)
    start = F.struct(F.lit(0.8).alias("prior"), four_in_five.alias("on_good"), four_in_five.alias("on_bad"))

    def step(model: Column, _: Column) -> Column:
        judged = F.transform(
            F.col("p"),
            lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), posterior(model, p["votes"]).alias("good")),
        )
        return let(judged, shares)

    def right(judged: Column, j: Column, vote: int, weight: Callable[[Column], Column]) -> Column:
        voted = _sum(judged, lambda p: weight(p) * F.abs(F.get(p["votes"], j)))
        agreed = _sum(judged, lambda p: F.when(F.get(p["votes"], j) == vote, weight(p)).otherwise(0.0))
        return _within(agreed, voted, 0.001, 0.999, 0.8)

    def shares(judged: Column) -> Column:
        on_good = F.transform(every, lambda j: right(judged, j, 1, lambda p: p["n"] * p["good"]))
        on_bad = F.transform(every, lambda j: right(judged, j, -1, lambda p: p["n"] * (1 - p["good"])))
        prior = _within(
            _sum(judged, lambda p: p["n"] * p["good"]), _sum(judged, lambda p: p["n"]), 0.01, 0.99, 0.8
        )
        return F.struct(
            prior.alias("prior"),
            on_good.alias("on_good"),
            F.zip_with(on_good, on_bad, lambda g, b: F.greatest(b, 1 - g)).alias("on_bad"),
        )

    model = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    return one.select(model.alias("model")).select("model.*")


def _sum(values: Column, of: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, p: total + of(p))


def _within(part: Column, whole: Column, low: float, high: float, otherwise: float) -> Column:
    share = F.when(whole > 0, part / whole).otherwise(otherwise)
    return F.greatest(F.lit(low), F.least(F.lit(high), share))


def posterior(model: Column, votes: Column) -> Column:
    """How probably a document with these votes is good. An abstaining rule
    says nothing."""

    def evidence(right: Column, vote: Column) -> Column:
        good, bad = right["on_good"], right["on_bad"]
        return F.when(vote == 1, F.log(good / (1 - bad))).when(vote == -1, F.log((1 - good) / bad)).otherwise(0.0)

    odds = F.aggregate(
        F.zip_with(F.arrays_zip(model["on_good"].alias("on_good"), model["on_bad"].alias("on_bad")), votes, evidence),
        F.log(model["prior"] / (1 - model["prior"])),
        lambda total, x: total + x,
    )
    return 1 / (1 + F.exp(-odds))


def judged(docs: DataFrame, names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The named columns, all measures, ``votes`` and ``quality``: the posterior
    probability that the document is good, under accuracies that are learned
    from all documents given."""
    rows = saved(
        measured(docs, *names).withColumn("votes", F.array(*[rule.vote() for rule in rules])), "votes"
    )
    patterns = saved(rows.groupBy("votes").agg(F.count("*").alias("n")), "patterns")
    model = saved(learn_accuracies(patterns, len(rules)), "accuracies")
    # One row of constants.
    learned = model.first()
    known = F.struct(
        F.lit(learned["prior"]).alias("prior"),
        *[F.array(*[F.lit(x) for x in learned[c]]).alias(c) for c in ("on_good", "on_bad")],
    )
    return rows.withColumn("quality", posterior(known, F.col("votes")))


def filtered(docs: DataFrame, threshold: float = THRESHOLD, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, measures, ``quality``, and ``kept``: not ``base_failed`` and of a
    quality of at least ``threshold``. ``base_failed`` are documents of fewer
    than 20 words and those with more than 30 of 100 words in repeated windows.

    NULL, empty and blank texts have no words and fail. Rows with equal ids or
    texts are judged each for itself, and equally. An empty table gives none.
    """
    rows = judged(docs, ("doc_id",), rules)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )
