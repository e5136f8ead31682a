"""Repair of conversations by a generalised LR parse of the roles.

The grammar is (s?(ua)+)?: an optional system row, then turns of user and
assistant. A row is kept, gets the other role or is deleted, and empty rows may
be inserted, each at a cost. The parser follows all of these at once on a
graph-structured stack: a node is what the parser has on top (nothing, system,
user, assistant) between two rows, and two ways into a node are merged by the
least (cost, audit), the audit being the letters of the edits in order.

The stack grows from the last row to the first. Two ways that leave a node then
differ in their first letter, so the letter alone decides between equal costs,
and no audit is ever compared or copied as a whole.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
# Bytes of a conversation that a task holds; a longer one waits in a file.
HELD = 1 << 23

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# What may follow each top: by the initial of a row that is kept, and the role
# that a row can be given or inserted with.
SHIFT = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
WANTED = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"


def _inserts(base: list[tuple[float, str]]) -> list[tuple[float, str]]:
    """The tops between two rows, once rows may be inserted there. Two inserted
    rows in a row lead back to the same top, so one is enough, or two before
    the first turn."""
    user = min(base[USER], (INSERT_COST + base[ASSISTANT][0], INSERT))
    assistant = min(base[ASSISTANT], (INSERT_COST + base[USER][0], INSERT))
    inserted = (INSERT_COST + user[0], INSERT)
    return [min(base[NOTHING], inserted), min(base[SYSTEM], inserted), user, assistant]


def cheapest_edits(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of rows (initial of the role, must
    go, truncated); of several, the one whose audit is least in ASCII."""
    never = float("inf")
    tops = _inserts([(0, ""), (never, ""), (never, ""), (0, "")])
    letters = [[letter for _, letter in tops]]
    for initial, gone, truncated in reversed(rows):
        extra = TRUNCATED_COST * truncated
        base = []
        for top in range(4):
            ways = [(DELETE_COST + tops[top][0], DELETE)]
            if not gone:
                ways.append((REROLE_COST + extra + tops[WANTED[top]][0], REROLE))
                if (after := SHIFT[top].get(initial)) is not None:
                    ways.append((extra + tops[after][0], KEEP))
            base.append(min(ways))
        tops = _inserts(base)
        letters.append([letter for _, letter in tops])
    letters.reverse()
    audit, at, top = [], 0, NOTHING
    while letter := letters[at][top]:
        audit.append(letter)
        if letter == KEEP:
            top = SHIFT[top][rows[at][0]]
        elif letter != DELETE:
            top = WANTED[top]
        at += letter != INSERT
    return int(tops[NOTHING][0]), "".join(audit)


@dataclass
class _Conversation:
    """What is known of a conversation while its rows pass in order."""

    ident: object
    rows: list[tuple[str, bool, bool]] = field(default_factory=list)
    seen: set[bytes] = field(default_factory=set)
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0))
    low: int | None = None
    high: int | None = None
    turns: int = 0

    def __post_init__(self) -> None:
        self.texts = tempfile.SpooledTemporaryFile(HELD)

    def add(self, turn: int | None, role: str, text: str) -> None:
        raw, name = text.encode(), role.encode()
        key = xxhash.xxh3_128_digest(struct.pack("<q", len(name)) + name + raw)
        stripped = text.rstrip(BLANKS)
        fault = None
        if not stripped:
            fault = "blank"
        elif key in self.seen:
            fault = "duplicate"
        elif stripped[-1] not in ".!?":
            fault = "truncated"
        self.seen.add(key)
        if fault:
            self.counts[fault] += 1
        if self.rows:
            self.counts["illegal"] += self.rows[-1][0] + role[:1] not in FOLLOWS
        self.rows.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.texts.write(struct.pack("<qq", len(name), len(raw)) + name + raw)

    def repaired(self) -> dict:
        cost, audit = cheapest_edits(self.rows)
        digest, top, first = hashlib.sha256(), NOTHING, True
        self.texts.seek(0)
        at = 0
        for letter in audit:
            role = text = b""
            if letter != INSERT:
                sizes = struct.unpack("<qq", self.texts.read(16))
                role, text = map(self.texts.read, sizes)
            if letter != DELETE:
                if letter == KEEP:
                    top = SHIFT[top][self.rows[at][0]]
                else:
                    top = WANTED[top]
                    role = NAMES[top].encode()
                digest.update((b"" if first else b"\n") + role + b":")
                digest.update(text)
                first = False
            at += letter != INSERT
        self.texts.close()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.counts | {"conv_id": self.ident, "gaps": gaps, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()}


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``rows`` (conv_id, turn, role, text; other
    columns are not looked at): gaps in its turns, rows with each fault, role
    changes that the grammar forbids, and the cost, audit and SHA-256 of the
    cheapest repair.

    NULL roles and texts count as one space, which makes the row blank or its
    role unknown; a NULL conv_id is a conversation of its own; NULL turns come
    first. Rows of one turn are ordered by role, then text, so repeated rows
    stand together and results do not depend on where rows lie. No rows give no
    rows. A conversation is read as a stream: its texts wait in a file beyond
    8 MB, and a task holds some 150 bytes for each of its rows.
    """
    rows = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    schema = StructType(
        [rows.schema["conv_id"]]
        + [StructField(name, LongType()) for name in COUNTS]
        + [StructField(name, StringType()) for name in ("audit", "repaired_sha256")]
    )
    kind = pa.schema(
        [("conv_id", pa.int64())] + [(n, pa.int64()) for n in COUNTS] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done, id_type = None, [], kind.field("conv_id").type
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for ident, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or ident != current.ident:
                    if current is not None:
                        done.append(current.repaired())
                    current = _Conversation(ident)
                current.add(turn, role, text)
            if len(done) > 1000:
                yield pa.RecordBatch.from_pylist(done, kind.set(0, pa.field("conv_id", id_type)))
                done = []
        if current is not None:
            done.append(current.repaired())
            yield pa.RecordBatch.from_pylist(done, kind.set(0, pa.field("conv_id", id_type)))

    return ordered.mapInArrow(run, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that repair looks for, dealt by a CRC of
    ``conv_id:turn``: one in twenty each is dropped, emptied, robbed of its
    sentence ends, repeated, or given to the user. NULLs count as one space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    role, text = spaced("role"), spaced("text")
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The repair of damaged conversations, for every conv_id, also of those
    that have no row left."""
    found = repair(damaged(conversations)).withColumnRenamed("conv_id", "found_id")
    ids = conversations.select("conv_id").distinct()
    counts: list[Column] = [F.coalesce(name, F.lit(0)).alias(name) for name in COUNTS]
    return ids.join(found, ids["conv_id"].eqNullSafe(found["found_id"]), "left").select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
