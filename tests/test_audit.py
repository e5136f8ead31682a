from __future__ import annotations

from datetime import date

import pytest

from tidemark.operators.audit import AuditFailure, audit, rule_counts
from tidemark.plans.downloads import audit_downloads
from tidemark.schemas import DOWNLOADS, INVALID_DOWNLOADS
from tidemark.sources.tables import scan_table

D = date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, DOWNLOADS.schema)


def good(i, n=1, country="US"):
    return (D, "p", str(i), "3.9", None, country, n)


def test_country_codes(spark):
    codes = ["US", "us", None, "US\n", "USA"]
    result = audit(frame(spark, [good(i, country=c) for i, c in enumerate(codes)]))
    # A final line break is accepted, NULL is no violation.
    assert result.counts == {"null_values": 0, "download_counts": 0, "country_codes": 2}


def test_row_breaking_two_rules_counts_twice(spark):
    rows = [good(1), good(2, n=0), good(3, n=-1), (D, "p", None, "3.9", None, "usa", 1)]
    result = audit(frame(spark, rows))
    assert result.total_invalid == 4
    assert result.invalid_ratio == 1.0
    assert result.invalid.count() == 4
    counts = rule_counts(frame(spark, rows)).first()
    assert (counts["total_invalid"], counts["row_count"]) == (4, 4)


def test_duplicates_fail_before_quarantine(spark, tmp_path):
    df = frame(spark, [good(1, country=None), good(1, country=None), good(2, n=0)])
    with pytest.raises(AuditFailure, match="duplicate"):
        audit_downloads(df, str(tmp_path / "q"), D)
    assert not (tmp_path / "q").exists()


def test_tolerance(spark, tmp_path):
    df = frame(spark, [good(1, n=0), *[good(i) for i in range(2, 11)]])
    path = str(tmp_path / "q")
    with pytest.raises(AuditFailure, match="ratio"):
        audit_downloads(df, path, D, tolerance=0.09)
    # The ratio equal to the tolerance passes, and 0 means no limit; the
    # retries do not add the invalid row again.
    assert audit_downloads(df, path, D, tolerance=0.1).invalid_ratio == 0.1
    audit_downloads(df, path, D, tolerance=0)
    assert scan_table(spark, path, INVALID_DOWNLOADS).count() == 1


def test_empty_table(spark, tmp_path):
    result = audit_downloads(frame(spark, []), str(tmp_path / "q"), D)
    assert (result.row_count, result.invalid_ratio) == (0, 0.0)
