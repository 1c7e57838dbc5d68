"""Queries with a SQL twin, and the whole set's registration."""

from __future__ import annotations

import pytest

import corpus_pipeline
from compare import differences, duck
from llm_fixtures import folder  # noqa: F401
from ledgerloom.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_twin(spark, folder, name):
    df = registry.QUERIES[name](spark, folder)
    assert differences(df, duck(folder), registry.ORACLE_SQL[name]) is None


def test_one_query_per_operator():
    numbers = [int(n.split("_")[0][2:]) for n in registry.QUERIES if n != "pipeline"]
    assert numbers == [*range(1, 14)] and "pipeline" in registry.QUERIES
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
