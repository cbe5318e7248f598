from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names clash with what the operators compute.
CLASHING = DOCS + ", key long, pos int, n_words long, name string, label int, rid long, shard int"


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) pairs; other columns are filled in."""

    def make(pairs, schema=DOCS):
        extra = len(schema.split(",")) - 5
        rows = [
            (i, t, "en", f"src{n % 3}", None if t is None else len(t), *[None] * extra)
            for n, (i, t) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, schema)

    return make


def prose(rng, n, vocabulary=400):
    """Random words, repeatable."""
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))
