"""Audit of the staged downloads: duplicates, three row rules, invalid ratio."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nulls import any_null
from tidemark.schemas import DOWNLOAD_KEYS

# What an invalid row is.
NOT_NULL = ("download_date", "project", "project_version", "download_count")
COUNTRY_PATTERN = "^[A-Z]{2}$"
TOLERANCE = 0.01


class AuditFailure(ValueError):
    """The staged table must not be published."""


def rules() -> dict[str, Column]:
    """Row rules in report order; a rule that is NULL for a row is not broken."""
    return {
        "null_values": any_null(NOT_NULL),
        "download_counts": F.col("download_count") <= 0,
        "country_codes": ~F.col("country_code").rlike(COUNTRY_PATTERN),
    }


def duplicate_keys(downloads: DataFrame) -> DataFrame:
    """Keys that occur more than once; NULLs count as equal."""
    return downloads.groupBy(*DOWNLOAD_KEYS).count().where("count > 1")


def invalid_rows(downloads: DataFrame) -> DataFrame:
    """Every broken rule's rows in one pass; a row that breaks two rules
    appears twice."""
    broken = F.filter(
        F.array(*[F.when(rule, F.lit(name)) for name, rule in rules().items()]),
        lambda name: name.isNotNull(),
    )
    return downloads.select("*", F.explode(broken).alias("rule"))


def rule_counts(downloads: DataFrame) -> DataFrame:
    """One row: rows per broken rule, their sum, and the row count."""
    counts = downloads.agg(
        *[F.count_if(rule).alias(name) for name, rule in rules().items()],
        F.count(F.lit(1)).alias("row_count"),
    )
    total = reduce(lambda a, b: a + b, [F.col(name) for name in rules()])
    return counts.select(*rules(), total.alias("total_invalid"), "row_count")


def with_invalid_ratio(counts: DataFrame) -> DataFrame:
    """Total over rows; an empty table has ratio 0."""
    ratio = F.when(F.col("row_count") > 0, F.col("total_invalid") / F.col("row_count"))
    return counts.withColumn("invalid_ratio", F.coalesce(ratio, F.lit(0.0)))


def audit_report(downloads: DataFrame) -> DataFrame:
    """All audit numbers as one row, from one scan and one shuffle: rows are
    grouped by key with their rule counts, then the groups are summed up."""
    by_key = downloads.groupBy(*DOWNLOAD_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(rule).alias(name) for name, rule in rules().items()],
    )
    counts = by_key.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules()],
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
    )
    total = reduce(lambda a, b: a + b, [F.col(name) for name in rules()])
    summed = counts.select(
        "duplicate_keys", *rules(), total.alias("total_invalid"), "row_count"
    )
    return with_invalid_ratio(summed)


@dataclass(frozen=True)
class AuditResult:
    duplicate_keys: int
    counts: dict[str, int]
    row_count: int
    invalid: DataFrame

    @property
    def total_invalid(self) -> int:
        return sum(self.counts.values())

    @property
    def invalid_ratio(self) -> float:
        return self.total_invalid / self.row_count if self.row_count else 0.0

    def raise_on_duplicates(self) -> None:
        if self.duplicate_keys:
            raise AuditFailure(f"{self.duplicate_keys} duplicate keys")

    def raise_on_ratio(self, tolerance: float) -> None:
        """Tolerance 0 switches this check off."""
        if tolerance > 0 and self.invalid_ratio > tolerance:
            raise AuditFailure(f"invalid ratio {self.invalid_ratio:.3f} over {tolerance}")


def audit(downloads: DataFrame) -> AuditResult:
    """Run the audit: one job, one row to the driver."""
    row = audit_report(downloads).first()
    return AuditResult(
        duplicate_keys=row["duplicate_keys"],
        counts={name: row[name] for name in rules()},
        row_count=row["row_count"],
        invalid=invalid_rows(downloads).drop("rule"),
    )
