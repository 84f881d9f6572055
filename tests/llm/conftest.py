"""Tables of the smaller data folders, and a frame of odd rows."""

from __future__ import annotations

import pytest

from postloom.llm.storage import share_package, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shared(spark):
    share_package(spark)


@pytest.fixture
def docs(spark):
    return table(spark, "/root/testdata/sf0.01", "documents")


@pytest.fixture
def frame(spark):
    """A documents table of (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows, extra=False):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] else None) for r in rows]
        made = spark.createDataFrame(full, SCHEMA)
        if extra:
            made = made.selectExpr("*", "1 AS kept", "'x' AS n_words", "2 AS row", "3 AS start", "4 AS id")
        return made

    return make


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "one two three four five six seven"),
    (4, "one two three four five six seven"),
    (4, "one two three four five six seven"),
    (5, "Über 😀 a@b.cc c"),
]
