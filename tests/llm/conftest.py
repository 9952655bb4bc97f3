import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts: ids from 0; None stays null."""

    def make(*texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources or ["s"] * len(texts))]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


#: Null, empty, white space, ties, repeated rows, marks, a very long text.
ODD = [None, "", " \n\t ", "a", "a", "A b c d e f.", "héllo wörld ñ 你好 😀 token = 'abcdef123'", "x" * 50_000, "word " * 20_000]
