from __future__ import annotations

import os
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.pathsep.join([ROOT]))


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of (doc_id, text) with further columns whose names the operators use inside."""

    def make(rows):
        schema = "doc_id long, text string, id string, score string, block string, print string, salt string"
        return spark.createDataFrame([(k, t, "i", "s", "b", "p", "x") for k, t in rows], schema)

    return make
