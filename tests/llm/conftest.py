import os
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
# The workers of a session that is still to be started import the package by this path.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")]).rstrip(os.pathsep)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text) pairs or dicts, with columns whose names operators use inside."""

    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long, digest string, key int, row int, fp int, chunk int, found string, y int, root long"):
        names = [c.split()[0] for c in schema.split(", ")]
        rows = [r if isinstance(r, dict) else dict(zip(names, r)) for r in rows]
        return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], schema)

    return make


@pytest.fixture
def odd(table):
    """Nulls in any column, empty and blank texts, repeated rows, one doc_id with two texts, a long text."""
    return table(
        [
            (1, "the quick brown fox jumps over the lazy dog and runs far away from here"),
            (2, "the quick brown fox jumps over the lazy dog and runs far away from here"),
            (2, "the quick brown fox jumps over the lazy dog and runs far away from here"),
            (None, "the quick brown fox jumps over the lazy dog and runs far away from here"),
            (3, None),
            (4, ""),
            (5, " \t\n"),
            (None, None),
            (6, "one"),
            (6, "two words"),
            (7, "word " * 20_000),
        ]
    )
