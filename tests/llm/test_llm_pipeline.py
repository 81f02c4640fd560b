"""The pipeline stage by stage against brute force, and the registered queries against SQL."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from llm_helpers import texts_of
from saleswright.llm import queries
from saleswright.llm.common import documents, kept
from saleswright.llm.tokens import Encoder, vocabulary_path
from test_llm_decontamination import by_hand as hits_by_hand
from test_llm_duplicates import groups_by_hand, near_by_hand, norm

NAMES = ["toxicity", "exact_dedup", "simhash_dedup", "decontamination", "best_fit_packing"]


@pytest.fixture(scope="module")
def stages(spark, data):
    """Input and output of each stage."""
    docs, out = documents(spark, data), {}
    for name, stage in corpus_pipeline.STAGES:
        after = kept(stage(spark, docs, data), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_stages_are_in_order_and_keep_the_columns(stages, spark, data):
    assert list(stages) == NAMES
    columns = documents(spark, data).columns
    for name in NAMES[:-1]:
        before, after = stages[name]
        assert after.columns == columns
        assert set(after.collect()) <= set(before.collect())


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    wanted = {(best[2], text) for text, (best, _) in groups_by_hand(texts_of(before)).items()}
    assert {(i, norm(t)) for i, t in texts_of(after)} == wanted


def test_near_stage(stages):
    before, after = stages["simhash_dedup"]
    found, _ = near_by_hand(texts_of(before))
    assert sorted(i for i, _ in texts_of(after)) == sorted({c for _, _, c in found})


def test_decontamination_stage(stages, spark, data):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in documents(spark, data, "benchmark").collect()]
    clean = {i for i, _, hits, _ in hits_by_hand(texts_of(before), items, 10) if not hits}
    assert {i for i, _ in texts_of(after)} == clean and after.count() < before.count()


def test_packing_stage_and_the_whole_run(stages, spark, data):
    before, after = stages["best_fit_packing"]
    encoder = Encoder(vocabulary_path("word_bpe_49k.json")).tokenizer
    tokens = sum(len(encoder.encode(t, add_special_tokens=False).ids) + 1 for _, t in texts_of(before))
    assert after.agg({"length": "sum"}).first()[0] == tokens
    columns = ["doc_id", "piece", "start", "length", "ids"]
    again = corpus_pipeline.run(spark, data).select(columns).collect()
    assert sorted(map(str, again)) == sorted(map(str, after.select(columns).collect()))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, data, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS FROM '{data}/{table}.parquet'")
    wanted = con.sql(queries.ORACLES[name])
    columns = sorted(wanted.columns)
    got = queries.QUERIES[name](spark, data).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(wanted.select(*columns).fetchall())


def test_every_operator_has_a_query_and_no_query_limits_its_tables():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    with open(os.path.join(os.path.dirname(queries.__file__), "queries.py")) as file:
        assert not re.search(r"\.(limit|sample|head|tail|take)\(", file.read())
