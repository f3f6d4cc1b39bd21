from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, row int, bits string, spans string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents from (id, text) pairs, with columns whose names operators use themselves."""
    def build(rows, partitions=3):
        full = [(i, t, "en", 7, "own", "own", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
