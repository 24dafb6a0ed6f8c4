import pytest

from corpusflow.llm.runtime import prepare

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def workers(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def table(workers):
    """Documents from (doc_id, text) pairs."""

    def make(rows, lang=None):
        full = [(i, t, lang, "s", None if t is None else len(t)) for i, t in rows]
        return workers.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def edge(table):
    """Nulls, empty and odd texts, repeated rows, a long text."""
    return table(
        [(1, None), (2, ""), (3, " \n\t "), (4, "!!!"), (5, "one"), (5, "one"), (None, "one two three"), (None, None),
         (6, "one two three four five six"), (7, "ONE TWO three four five six"), (8, "é漢字😀 ß" * 3), (9, "word " * 20_000)]
    )
