from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Documents from texts; ids count from 1, and columns that clash with the operators' own names come along."""

    def make(texts, ids=None, **more):
        ids = list(range(1, len(texts) + 1)) if ids is None else ids
        rows = [(i, t, "x", -1, -2) for i, t in zip(ids, texts, strict=True)]
        schema = "doc_id bigint, text string, kept string, n_tokens int, component_id int"
        return spark.createDataFrame(rows, schema)

    return make
