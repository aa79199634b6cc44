"""Small tables with the awkward rows that every text operator has to take."""

from __future__ import annotations

import random

import pytest
from odd import COLUMNS, odd_texts


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, repeated rows, NULLs in every column, and columns with clashing names."""
    rng = random.Random(5)
    texts = odd_texts(rng)
    rows = [
        (i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None, i, None)
        for i, t in enumerate(texts)
    ]
    rows += [rows[5], rows[5], (None, texts[5], None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
