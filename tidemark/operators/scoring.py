"""A sentiment score for every mentioned project, by a pluggable batch scorer.

A scorer takes a batch of (projects, text) and returns, for each, a list of
(project, summary, polarity). It sees only texts that mention something.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.mentions import mentioned_projects
from tidemark.schemas import POLARITY_TYPE

Scored = Sequence[tuple[str, str, float]]
Scorer = Callable[[Sequence[tuple[Sequence[str], str]]], Sequence[Scored]]

_ARROW_TYPE = pa.list_(
    pa.struct([("project", pa.string()), ("summary", pa.string()), ("polarity", pa.float64())])
)


def score_mentions(
    df: DataFrame,
    scorer: Scorer,
    mentions: str = "projects_mentions",
    text: str = "text",
    output: str = "projects_mentions_polarity",
) -> DataFrame:
    """Add the scorer's list for each row with mentions, NULL for the others.

    Python runs on Arrow batches. The text is blanked out for rows without
    mentions before it leaves the JVM, so a row that needs no score costs
    neither transfer nor a call, and no join is needed to bring rows together.
    The function counts as nondeterministic, as a model may be: Spark then
    calls it once per row, whatever is done with the result.
    """

    @F.arrow_udf(POLARITY_TYPE)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for projects, texts in batches:
            names, bodies = projects.to_pylist(), texts.to_pylist()
            wanted = [i for i, body in enumerate(bodies) if body is not None]
            results = [None] * len(bodies)
            scored = scorer([(names[i], bodies[i]) for i in wanted]) if wanted else []
            for i, items in zip(wanted, scored, strict=True):
                results[i] = [
                    {"project": p, "summary": s, "polarity": v} for p, s, v in items
                ] or None
            yield pa.array(results, type=_ARROW_TYPE)

    once = run.asNondeterministic()
    has_mentions = F.col(mentions).isNotNull()
    return df.withColumn(
        output,
        once(
            F.when(has_mentions, mentioned_projects(F.col(mentions))),
            F.when(has_mentions, F.coalesce(F.col(text), F.lit(""))),
        ),
    )


def lexicon_scorer() -> Scorer:
    """The built-in deterministic scorer: good against bad words of the whole
    text, with the first sentence as the summary. A closure, so that it
    reaches the executors by value."""
    good = frozenset(
        "good great love excellent fast easy best nice reliable solid amazing helpful stable".split()
    )
    bad = frozenset(
        "bad slow hate terrible broken hard worst buggy awful expensive unstable painful poor".split()
    )
    word, sentence_end = re.compile(r"\w+"), re.compile(r"(?<=[.!?])\s+")

    def score(batch: Sequence[tuple[Sequence[str], str]]) -> list[Scored]:
        results = []
        for projects, text in batch:
            words = word.findall(text.lower())
            liked, disliked = sum(w in good for w in words), sum(w in bad for w in words)
            total = liked + disliked
            polarity = round((liked - disliked) / total, 3) if total else 0.0
            summary = sentence_end.split(text.strip(), maxsplit=1)[0]
            results.append([(project, summary, polarity) for project in projects])
        return results

    return score
