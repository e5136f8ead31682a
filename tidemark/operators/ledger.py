"""What each partition of a table held when something was derived from it.

A ledger has a row for each partition: a signature of its files and, where its
rows were read, their number and two order-free checksums. Comparing ledgers
tells which partitions were added, removed or changed since, whatever the times
of their files say: files that differ are read again, and only other rows count
as a change, so that a compacted partition is none.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.schemas import Table
from tidemark.sources.tables import read_partitions

SCHEMA = "value string, files string, n_rows long, checksum long, total decimal(38,0)"


@dataclass(frozen=True)
class Entry:
    files: str
    n_rows: int | None = None
    checksum: int | None = None
    total: Decimal | None = None

    def same_rows(self, other: Entry) -> bool:
        if self.files == other.files:
            return True
        return self.n_rows is not None and astuple(self)[1:] == astuple(other)[1:]


Ledger = dict[str | None, Entry]


def contents(rows: DataFrame, table: Table) -> DataFrame:
    """Number and checksums of the rows of each partition; equal for equal rows
    in any order and any number of files."""
    columns = [F.col(name) for name in table.schema.names]
    second = F.xxhash64(F.lit(1), *columns).cast("decimal(20,0)")
    return rows.groupBy(F.col(table.partition).cast("string").alias("value")).agg(
        F.count("*").alias("n_rows"),
        F.bit_xor(F.xxhash64(*columns)).alias("checksum"),
        F.sum(second).cast("decimal(38,0)").alias("total"),
    )


def take(spark: SparkSession, path: str, table: Table, known: Ledger | None = None, *, read: bool = True) -> Ledger:
    """The ledger of a table. Partitions whose files are as in ``known`` are not
    read; with ``read=False`` none is."""
    known, now, fresh = known or {}, {}, []
    for value, files in storage.file_signatures(spark, path, table.partition).items():
        now[value] = known.get(value)
        if now[value] is None or now[value].files != files:
            now[value] = Entry(files)
            fresh.append(value)
    if read and fresh:
        found = contents(read_partitions(spark, path, table, fresh), table)
        for row in found.collect():
            now[row.value] = Entry(now[row.value].files, row.n_rows, row.checksum, row.total)
    # Files without rows are as good as none.
    empty = {value for value in fresh if read and now[value].n_rows is None}
    return {value: entry for value, entry in now.items() if value not in empty}


def changed(before: Ledger, now: Ledger) -> set[str | None]:
    """The partitions that were added or removed, or hold other rows."""
    both = before.keys() & now.keys()
    return (before.keys() ^ now.keys()) | {v for v in both if not before[v].same_rows(now[v])}


def write(spark: SparkSession, ledger: Ledger, path: str) -> None:
    rows = [(value, *astuple(entry)) for value, entry in ledger.items()]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> Ledger | None:
    """A ledger that was written, one row a partition; None where there is none."""
    if not storage.exists(spark, path):
        return None
    rows: Iterable = spark.read.schema(SCHEMA).parquet(path).collect()
    return {r.value: Entry(r.files, r.n_rows, r.checksum, r.total) for r in rows}


def place(path: str, label: str) -> str:
    """Where a derived table keeps a ledger; readers of the table skip it."""
    return f"{path}/_ledger/{label}"
