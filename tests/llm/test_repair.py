"""Repairs against a search over every sequence of edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tests.conftest import SF
from tidemark.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def plain_edits(rows):
    """(cost, audit, repaired rows) by cheapest-first search over all edits of
    (role, text, fault); every state is a whole list of roles."""
    heap, seen = [(0, "", 0, ())], set()
    while heap:
        cost, audit, at, out = heapq.heappop(heap)
        roles = "".join(r[:1] or "?" for r, _ in out)
        if at == len(rows) and GRAMMAR.fullmatch(roles):
            return cost, audit, out
        if (audit, at, roles) in seen:
            continue
        seen.add((audit, at, roles))
        if not re.fullmatch(r"s?(ua)*u?", roles):
            continue
        ways = [(2, "I", 0, (role, "")) for role in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            ways.append((3, "D", 1, None))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                ways.append((extra, "K", 1, (role, text)))
                ways += [(2 + extra, "R", 1, (new, text)) for new in ("user", "assistant")]
        for more, letter, step, row in ways:
            heapq.heappush(heap, (cost + more, audit + letter, at + step, out + ((row,) if row else ())))


def plain(rows):
    """The result row of one conversation of (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, judged, faults = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        fault = None
        if not text.strip(BLANK):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.rstrip(BLANK)[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        judged.append((role, text, fault))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit, out = plain_edits(judged)
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (gaps, *faults.values(), illegal, cost, audit, digest)


def result(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def damage(rows):
    """(conv_id, turn, role, text) rows after damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def grouped(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def test_query_equals_search(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    left = grouped(damage(rows))
    want = {c: plain(left.get(c, [])) for c in {r[0] for r in rows}}
    assert result(repair.damaged_and_repaired(table)) == want
    assert {letter for r in want.values() for letter in r[6]} == set("KRDI")


def test_small_conversations_equal_search(spark):
    draw = random.Random(17)
    rows = []
    for conv in range(250):
        for _ in range(draw.randint(1, 5)):
            role = draw.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None])
            text = draw.choice(["Yes.", "No!", "so it", "", " \t", "Why? ", None])
            rows.append((conv, draw.choice([None, 0, 1, 2, 5, 9]), role, text))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    want = {c: plain(r) for c, r in grouped(rows).items()}
    assert result(repair.repair(df)) == want


def test_every_short_list_of_roles():
    """All role sequences of up to four rows, with and without faults."""
    kinds = [(r, g, t) for r in "sua " for g, t in ((False, False), (False, True), (True, False))]
    draw = random.Random(2)
    for n in range(5):
        for _ in range(12**n if n < 3 else 300):
            rows = [draw.choice(kinds) for _ in range(n)]
            judged = [(r, "x", "blank" if g else "truncated" if t else None) for r, g, t in rows]
            assert repair.cheapest_edits(rows) == plain_edits(judged)[:2]


def test_long_conversations_keep_their_texts_in_a_file(spark, monkeypatch):
    rows = [(1, i, "user" if i % 2 else "assistant", f"turn {i}." * (i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = result(repair.repair(df))
    monkeypatch.setattr(repair, "HELD", 10)
    assert result(repair.repair(df)) == whole
    assert len(whole[1][6]) >= 400 and whole[1][1] == sum(i % 7 == 0 for i in range(400))


def test_a_very_long_conversation_takes_linear_time():
    cost, audit = repair.cheapest_edits([(" ", False, False)] * 100_001)
    assert (cost, len(audit)) == (200_003, 100_001)
    assert audit == "D" + "R" * 100_000


@pytest.mark.parametrize("kind", ["long", "string"])
def test_edge_rows(spark, kind):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", ""), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (2, 0, "assistant", "x" * 100_000)]
    df = spark.createDataFrame([(c if c is None or kind == "long" else str(c), *r) for c, *r in rows], f"conv_id {kind}, turn long, role string, text string")
    wide = df.selectExpr("*", "1 as gaps", "'x' as audit", "2 as cost", "3 as copy", "4 as found_id", "5 as repaired_sha256")
    want = {c: plain(r) for c, r in grouped(rows).items()}
    assert {c if c is None else int(c): r for c, r in result(repair.repair(wide)).items()} == want
    after = grouped(damage(rows))
    want = {c: plain(after.get(c, [])) for c in grouped(rows)}
    assert {c if c is None else int(c): r for c, r in result(repair.damaged_and_repaired(wide)).items()} == want
    assert repair.repair(df.limit(0)).collect() == []
    assert repair.damaged_and_repaired(df.limit(0)).collect() == []


def test_no_rows_after_damage(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert result(repair.damaged_and_repaired(df)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
