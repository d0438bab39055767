"""Every registered query against its SQL, or for rows where SQL cannot express it."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
from seasonlens.models.learners import Settings  # noqa: E402

QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return compare.connect(sf_dir)


def test_registry():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, db, sf_dir, name):
    assert compare.compare(spark, db, QUERIES[name], ORACLE[name], sf_dir) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, sf_dir, name, monkeypatch):
    """Training is made short here; the models are tested by themselves."""
    short = Settings(trees=4, units=8, epochs=3, boosting_rounds=3)
    for module in ("queries.models", "queries.composites"):
        monkeypatch.setattr(f"seasonlens.{module}.SETTINGS", short)
    monkeypatch.setattr("seasonlens.models.learners.FOREST_GRID", {"trees": [2, 4], "depth": [None, 3]})
    assert QUERIES[name](spark, sf_dir).count() > 0
