"""Small tables for the operators' tests."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) or longer rows, with an extra column whose name clashes with inner ones."""

    def build(rows):
        from pyspark.sql import functions as F

        full = [(*r, *(None, "s", len(r[1]) if r[1] is not None else None)[len(r) - 2 :]) if len(r) < 5 else r for r in rows]
        frame = spark.createDataFrame(full, SCHEMA)
        return frame.withColumns({c: F.lit(1) for c in ("node", "spans", "base", "n", "cluster")})

    return build
