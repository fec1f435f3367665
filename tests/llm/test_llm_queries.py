"""Every query of the subpackage on driver tables: against its SQL, or in its shape and rules."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from corpus_pipeline import STAGES, run
from firstprint.llm.queries.registry import QUERIES
from tools.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    text, ok = compare(spark, con, SF, name, queries()[name], oracle_sql().get(name))
    assert ok, text


def test_pipeline_is_its_stages_one_after_another(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    by_sql = lambda name: {r[0]: r for r in con.execute(oracle_sql()[name]).fetchall()}
    for name, stage in STAGES[:-1]:
        columns = docs.columns
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        now = {r["doc_id"] for r in docs.collect()}
        assert docs.columns == columns and now <= kept
        if name == "quality_rules":  # the first stage sees the whole table, as the query does
            assert now == {i for i, r in by_sql("op6_quality_rules").items() if r[-1]}
        if name == "near_duplicates":
            whole = {i: r for i, r in by_sql("op10_minhash_near_dedup").items()}
            assert {whole[i][2] for i in kept} == {whole[i][2] for i in now} or len(now) < len(kept)
        if name == "benchmark_decontamination":
            assert now == {i for i in kept if not by_sql("op9_benchmark_decontamination")[i][-1]}
        kept = now
    packed = run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == kept


def test_stages_reject_rows_without_an_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    words = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, words), (None, words), (None, "alone " + words[::-1]), (None, "so " + item), (2, "other " * 9)],
                                 "doc_id bigint, text string")
    left = lambda name: sorted((r["doc_id"] or 0, r["text"][:5]) for r in dict(STAGES)[name](spark, docs, SF).collect())
    assert left("near_duplicates") == sorted([(1, words[:5]), (0, "alone"), (0, ("so " + item)[:5]), (2, "other")])
    assert left("benchmark_decontamination") == sorted([(1, words[:5]), (0, words[:5]), (0, "alone"), (2, "other")])
