from __future__ import annotations

import duckdb
import pytest
from corpus_rows import SCHEMA, SF, edge_texts

@pytest.fixture(scope="session")
def rows():
    got = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet'").fetchall()
    extra = [(i, t, None if k % 3 else "en", f"s{k}", len(t or "")) for k, (i, t) in enumerate(edge_texts())]
    return [(*r, "extra", 7, None) for r in got + extra]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Documents with edge cases and columns whose names operators use."""
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
