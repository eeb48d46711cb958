"""The registered corpus queries: SQL twins, held-out accuracy, the pipeline."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from fareflow.llm import queries as Q
from fareflow.llm.common import staged
from fareflow.sources.tables import load_table
from tools.oracle_check import compare, duck_con

from ..conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ok, msgs, ns, nd = compare(Q.QUERIES[name](spark, SF_SMALL), duck_con(SF_SMALL), Q.ORACLE_SQL[name])
    assert ok, f"{name}: spark={ns} duck={nd} {msgs}"


def test_all_corpus_queries_are_registered():
    assert {*Q.QUERIES, "pipeline"} <= set(E.queries())
    assert [name.split("_")[0] for name in Q.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_language_held_out_accuracy(spark):
    docs = load_table(spark, SF_SMALL, "documents").select("doc_id", "lang")
    got = Q.op3_language_id(spark, SF_SMALL).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)


def test_pipeline_stages_take_effect(spark):
    docs = load_table(spark, SF_SMALL, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]
    assert docs.select("doc_id").distinct().count() == sizes[-1]
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert mixed.columns[:len(columns)] == columns and mixed.count() == sizes[-1]
