import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cuts string, own string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (ids from 0, or pairs of id and text), with columns of clashing names."""

    def make(texts, ids=None):
        rows = [
            (i, t, "en", "src", None if t is None else len(t), "x", "y")
            for i, t in zip(range(len(texts)) if ids is None else ids, texts)
        ]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def make_labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
