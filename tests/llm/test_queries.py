"""The registered queries, against their SQL where there is one, and the pipeline's stages."""

from collections import Counter

import corpus_pipeline
import pytest
from registry.compare import connect, difference
from registry.register import Entry

import __spark_entry__ as entry_points
from touchline.llm import queries


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_every_operator_is_registered_once():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry_points.queries())
    assert set(queries.ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_against_sql(spark, connection, folder, name):
    assert difference(spark, connection, folder, Entry(queries.QUERIES[name], queries.ORACLE_SQL[name])) is None


def test_pipeline(spark, folder):
    """What each stage does to its own input, by the operator's result on that input."""
    docs = queries.read(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = queries_written(stage(spark, docs, folder))
        assert out.columns == docs.columns
        before, after = Counter(r.doc_id for r in docs.collect()), Counter(r.doc_id for r in out.collect())
        if name == "quality rules":
            assert after == Counter(r.doc_id for r in queries.quality(docs).collect() if r.kept)
        elif name == "ngram join":
            assert after == Counter(r.doc_id for r in queries.ngram_join(docs).collect() if r.kept)
        elif name == "personal data":
            assert after == before and not out.filter("text RLIKE '[A-Za-z0-9]@[A-Za-z0-9]+\\\\.'").count()
        else:
            used = {r.doc_id: r.times for r in queries.mixture(docs).collect() if r.times}
            assert after == Counter(used)
        docs = out
    packed = corpus_pipeline.STAGES[4][1](spark, docs, folder).collect()
    whole = Counter(r.doc_id for r in packed if r.piece == 0)
    assert whole == Counter(r.doc_id for r in docs.collect())


def queries_written(df):
    from touchline.llm.words import written

    return written(df, "stage")
