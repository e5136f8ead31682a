from __future__ import annotations

import json

from tidemark.plans.dimensions import build_dims
from tidemark.schemas import POLARITY_CATEGORIES, TRACKED_PROJECTS, TRACKED_SUBREDDITS
from tidemark.sources.dimensions import (
    BANDS,
    SUBREDDITS,
    TRACKED,
    package_names,
    projects_from_json,
)
from tidemark.sources.tables import scan_table


def test_fixed_values():
    assert len(TRACKED) == 113
    assert sum(len(p.terms) for p in TRACKED) == 124
    assert sum(p.package is not None for p in TRACKED) == 71
    assert sum(c != c.strip() for p in TRACKED for c in p.categories) == 6
    assert len(SUBREDDITS) == 6
    assert [b.order for b in BANDS] == [1, 2, 3, 4, 5]


def test_build_twice(spark, tmp_path):
    for _ in range(2):
        paths = build_dims(spark, str(tmp_path / "dims"))
    projects = scan_table(spark, paths[TRACKED_PROJECTS.name], TRACKED_PROJECTS)
    assert projects.count() == 113
    assert package_names(projects).count() == 71
    assert scan_table(spark, paths[POLARITY_CATEGORIES.name], POLARITY_CATEGORIES).count() == 5
    subreddits = scan_table(spark, paths[TRACKED_SUBREDDITS.name], TRACKED_SUBREDDITS)
    assert ("LocalLLaMA", "https://reddit.com/r/localllama") in {tuple(r) for r in subreddits.collect()}


def test_projects_as_a_parameter():
    text = json.dumps(
        [{"project_name": "A", "project_search_terms": ["a", "b"], "pypi": None, "project_categories": ["c"]}]
    )
    (project,) = projects_from_json(text)
    assert (project.name, project.terms, project.package, project.categories) == ("A", ("a", "b"), None, ("c",))
