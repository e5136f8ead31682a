r"""Search terms as regular expressions and as the word a match can start with.

A term matches whole words, ignoring case, with its words written together,
hyphenated or spaced: ``Duck DB`` finds ``duckdb``, ``Duck-DB`` and ``duck db``.

Word boundaries are written out as look-arounds over letters, digits and
underscore. That is what ``\b`` means in Python for every script; the meaning
of Java's ``\b`` depends on the JDK and on flags.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]+"
# Python's \s: Unicode white space and the four ASCII separators.
_GAP = r"[-\s\x1c-\x1f]?"
# Python's white space and the hyphen: what parts the words of a term.
GAP_CHARACTERS = r"(?U)[-\s\x1c-\x1f]+"
# Unicode case folding, and \s by Unicode property.
_FLAGS = "(?iuU)"
# Characters beyond ASCII that equal an ASCII letter when case is ignored.
CASE_ODDITIES = "\u0130\u0131\u017f\u212a"

_EITHER = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
_SPLIT = re.compile(r"[-\s]+")
_META = re.compile(r"([^\w\s])")


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _boundary(char: str, *, before: bool) -> str:
    """The look-around that stands for a word boundary next to ``char``."""
    arrow = "<" if before else ""
    sign = "!" if _is_word(char) else "="
    return f"(?{arrow}{sign}{WORD})"


def term_pattern(term: str) -> str:
    """The Java regular expression for a search term."""
    words = _SPLIT.split(term)
    text = "".join(words)
    if not text:
        raise ValueError(f"search term without a word: {term!r}")
    body = _GAP.join(map(_escaped, words))
    # The first letter is checked ahead of the boundary: it is the cheaper
    # test, and fails at most positions.
    first = f"(?={_escaped(text[0])})" if words[0] else ""
    start = _edge(words[0], text[0], before=True)
    end = _edge(words[-1], text[-1], before=False)
    return f"{_FLAGS}{first}{start}{body}{end}"


def _escaped(word: str) -> str:
    # Quotes by their code, so that a pattern also fits in a SQL string.
    quoted = {'"': r"\x22", "'": r"\x27"}
    return _META.sub(lambda m: quoted.get(m[1], "\\" + m[1]), word)


def _edge(word: str, char: str, *, before: bool) -> str:
    # A term that begins or ends with a separator has an optional gap at its
    # edge, so a boundary of either direction may follow or precede it.
    return _boundary(char, before=before) if word else _EITHER


def pattern_column(term: Column) -> Column:
    """``term_pattern`` of a column of terms."""
    words = F.split(term, GAP_CHARACTERS, -1)
    escaped = F.transform(words, lambda w: F.regexp_replace(w, r"([^\p{L}\p{N}_])", r"\\$1"))

    def edge(word: Column, char: Column, before: bool) -> Column:
        is_word = char.rlike(WORD)
        side = F.when(is_word, F.lit(_boundary("a", before=before))).otherwise(F.lit(_boundary(".", before=before)))
        return F.when(word == "", F.lit(_EITHER)).otherwise(side)

    first, last = F.get(words, F.lit(0)), F.element_at(words, -1)
    start = edge(first, F.substring(first, 1, 1), before=True)
    end = edge(last, F.substring(last, -1, 1), before=False)
    return F.concat(F.lit(_FLAGS), start, F.array_join(escaped, _GAP), end)


def folded(text: Column) -> Column:
    """A text in which letters that are equal without case are equal. Letters
    are mapped one by one: a word's fold does not depend on what is around it."""

    # Catalyst takes one case mapping right above another for the outer one
    # alone, which leaves letters like the long s.
    def sigma(mapped: Column) -> Column:
        return F.translate(mapped, "\u03c2", "\u03c3")

    upper = F.upper(sigma(F.lower(F.translate(text, "\u0130", "i"))))
    return sigma(F.lower(sigma(upper)))


def leading_words(term: str) -> list[str] | None:
    """Lower-case words one of which must stand, whole, where a match begins.

    None when no such list exists: the term starts with punctuation, or has
    letters whose case rules go beyond ASCII.
    """
    words = _SPLIT.split(term.lower())
    if not term.isascii() or not words[0] or not _is_word(words[0][0]):
        return None
    found, joined = [], ""
    for word in words:
        run = re.match(r"\w*", word, re.ASCII).group()
        joined += run
        if joined not in found:
            found.append(joined)
        if run != word:
            break
    return found


def is_plain_word(term: str) -> bool:
    """Whether the term is one ASCII word, so that its matches are the words
    of a text that equal it."""
    return re.fullmatch(r"\w+", term, re.ASCII) is not None


def term_count(text: Column, term: str) -> Column:
    """Non-overlapping matches of a term; NULL text gives NULL."""
    return F.regexp_count(text, F.lit(term_pattern(term)))


def has_case_oddities(text: Column) -> Column:
    """Whether a text holds one of those letters; four byte searches, which
    cost less than one regular expression."""
    return reduce(or_, [F.contains(text, F.lit(letter)) for letter in CASE_ODDITIES])


def text_words(text: Column) -> Column:
    """Lower-case words of a text, in order, from one pass over it."""
    return F.split(F.lower(text), NOT_WORD)


def word_counts(text: Column, wanted: Sequence[str]) -> Column:
    """Map of the wanted words (of ASCII letters) that a text holds, with how
    often it does. Each text is cut into words once, and most hold none."""

    def counts(words: Column) -> Column:
        literals = ", ".join(f"'{word}'" for word in wanted)
        held = F.array_intersect(words, F.expr(f"array({literals})"))
        return _bind(held, lambda present: F.map_from_arrays(present, _occurrences(words, present)))

    return _bind(text_words(text), counts)


def _occurrences(words: Column, present: Column) -> Column:
    return F.transform(present, lambda p: F.size(F.filter(words, lambda w: w == p)))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times and compute it once."""
    return F.element_at(F.transform(F.array(value), use), 1)
