from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents frame from texts or (doc_id, text, source) tuples; ids count from 0."""

    def make(rows, extra=()):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, source = r if isinstance(r, tuple) else (i, r, f"src{i % 2}")
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        frame = spark.createDataFrame(full, DOCS)
        for name in extra:  # columns that an operator might use itself
            from pyspark.sql import functions as F

            frame = frame.withColumn(name, F.lit(f"own {name}"))
        return frame

    return make


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
