"""The pipeline's stages, and the corpus queries as registered."""

import os

import pytest
from compare import assert_same, oracle_frame

import __spark_entry__ as contract
import corpus_pipeline
from ticketloom.llm import language, simhash, toxicity
from ticketloom.llm.oracle import ORACLE_SQL
from ticketloom.llm.queries import QUERIES, read_table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_every_operator_is_registered_once():
    numbers = [name.split("_")[0] for name in QUERIES]
    assert numbers == [f"op{n}" for n in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= contract.queries().keys()


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, name):
    assert_same(contract.queries()[name](spark, SF_DIR).toPandas(), oracle_frame(ORACLE_SQL[name], SF_DIR))


def test_stages_keep_what_their_operators_accept(spark):
    docs = read_table(spark, SF_DIR, "documents")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    clean = corpus_pipeline.stored(stages["toxicity"](spark, docs, SF_DIR), "stage")
    scores = toxicity.score(docs, toxicity.fit(docs, read_table(spark, SF_DIR, "labels")))
    assert ids(clean) == ids(scores.where("predicted = 0"))

    clear = corpus_pipeline.stored(stages["language_id"](spark, clean, SF_DIR), "stage")
    found = language.identify(clean, language.fit(clean))
    assert ids(clear) == ids(found.where("lang_pred <> 'und' and score >= 0.005"))

    single = corpus_pipeline.stored(stages["simhash_near_dedup"](spark, clear, SF_DIR), "stage")
    assert ids(single) == ids(simhash.near_duplicates(clear).where("doc_id = component_id"))
    assert clean.columns == clear.columns == single.columns == docs.columns

    packed = stages["best_fit_packing"](spark, single, SF_DIR)
    assert sorted({r.doc_id for r in packed.collect()}) == ids(single)
