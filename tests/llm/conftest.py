import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, spans int, class_id int, __row int, start int"
"""Columns of documents, and some whose names the operators use themselves."""


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """The frames are small, and the operators make many of them."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a frame of documents from ``(doc_id, text)`` or ``(doc_id, text, source)``."""

    def make(rows):
        full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", 0, "d", 1, 2, 3, 4) for row in rows]
        return spark.createDataFrame(full, DOCS)

    return make
