"""The five stages, each on what its predecessor kept, and the registered queries."""

import __spark_entry__ as contract
import corpus_pipeline
import pytest
from check import compare
from wxpipe.llm import queries
from wxpipe.llm.chosen_path import near_duplicates

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, staging):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = staging.write(stage(spark, docs, SF), f"s{n}")
        assert docs.columns == columns
        assert docs.count() <= before
        before = docs.count()
    assert 0 < before < 200
    out = corpus_pipeline.pieces(spark, docs, SF)
    assert out.where("round_trip").select("doc_id").distinct().count() == before


def test_no_surplus_copy_survives(spark, staging):
    """Of each group of near-duplicate originals that reach the stage, one document is left."""
    folder = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    classes = near_duplicates(docs, shingle=5, percent=80).collect()
    group = {r["doc_id"]: r["component_id"] for r in classes}
    sizes = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        docs = staging.write(stage(spark, docs, folder), f"c{n}")
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        sizes.append((len(ids), len({group[i] for i in ids})))
    assert sizes[1][0] > sizes[1][1]  # line dedup alone leaves some
    assert sizes[2] == (sizes[1][1], sizes[1][1])


def test_pipeline_of_odd_documents(spark, staging):
    """Nulls, empty and long texts, repeated rows, ties and clashing names, through all stages."""
    words = " ".join(f"w{n % 300}" for n in range(40_000))
    rows = [(None, "nameless text " * 20), (1, None), (2, ""), (3, words), (3, words), (4, "a b"), (5, "a b")]
    docs = spark.createDataFrame(
        [(i, t, "en", None, None, 0.5, "x") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score double, removed string",
    )
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        docs = staging.write(stage(spark, docs, SF), f"o{n}")
        assert n == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    assert docs.where("NOT round_trip").count() == 0


def test_pipeline_of_no_documents(spark, staging):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = staging.write(stage(spark, docs, SF), f"e{n}")
    assert docs.count() == 0


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_runs_and_matches_its_sql(spark, name):
    ok, note = compare(spark, name, SF)
    assert ok, note


def test_registered():
    numbers = {name.split("_")[0] for name in contract.queries() if name.startswith("op")}
    assert {f"op{n}" for n in range(1, 14)} <= numbers
    assert "pipeline" in contract.queries()
