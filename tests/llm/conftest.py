import pytest


@pytest.fixture(scope="module")
def docs_of(spark):
    """Documents with the columns of the table, from (doc_id, text) pairs."""

    def make(rows, **more):
        full = [(i, t, more.get("lang", "en"), "s", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


#: Nulls, empty and blank texts, ties and repeated rows, one very long text.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "Same text, twice."), (6, "Same text, twice."), (6, "Same text, twice."),
    (None, "no id here"), (7, "é" * 300), (8, "word " * 60_000), (9, "<|endoftext|> x"),
]


@pytest.fixture(scope="module")
def edges():
    return EDGES
