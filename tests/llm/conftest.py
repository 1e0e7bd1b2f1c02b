from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text[, lang]) rows."""
    def build(rows):
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or "")) for r in rows],
            COLUMNS)

    return build


# Nulls in every column, empty and white-space texts, a repeated row, one very long word.
HARD = [(1, None), (2, ""), (3, " \t\n"), (4, "one two three"), (4, "one two three"),
        (None, "no id at all here"), (None, None), (5, "x" * 30_000), (6, "é ß 日本 🙂 ok")]


@pytest.fixture
def hard(documents):
    """Awkward rows, with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    return documents(HARD).withColumns({c: F.lit("mine") for c in (
        "text_sha256", "kept", "piece", "score", "spans", "row", "band", "node", "id", "found")})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
