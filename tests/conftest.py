from __future__ import annotations

import sys
from pathlib import Path

import pytest
from hypothesis import settings

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import build_session  # noqa: E402

# The same examples in every run.
settings.register_profile("fixed", derandomize=True)
settings.load_profile("fixed")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
