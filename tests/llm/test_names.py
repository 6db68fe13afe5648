"""Columns of the input whose names the operators use themselves come back with their values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from matchvault.llm import decontaminate, jaccard, pieces, resample, secrets_scan
from matchvault.llm.store import set_aside, unused
from tests.llm.conftest import SF

NAMES = ["version", "found", "Key", "kept", "n_grams", "log_weight", "_text", "_key", "text_lower", "text_or_empty", "row_key",
         "score", "node", "token", "root", "component_id", "scan__text", "scan__joined", "row_id", "scanned", "VERSION_"]


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in NAMES})


def unchanged(rows, columns=NAMES):
    assert rows
    for r in rows:
        assert [r[c] for c in columns] == [f"{c} of {r.doc_id}" for c in columns]


def test_unused_names_and_columns_set_aside(spark):
    assert unused(["a", "B"], "b") == "b_" and unused(["a", "b", "B_"], "b") == "b__" and unused([], "x") == "x"
    df = spark.createDataFrame([(1, 2, 3)], "Key long, key_ long, other long")
    aside, restored = set_aside(df, "key", "absent")
    assert "key" not in [c.lower() for c in aside.columns]
    out = restored(aside.withColumn("key", F.lit(9)))
    assert out.columns == df.columns and tuple(out.first()) == (1, 2, 3)


@pytest.mark.parametrize("at", range(4))
def test_stages_keep_the_values_of_all_columns(spark, clashing, at):
    name, stage = corpus_pipeline.STAGES[at]
    plain = {r.doc_id for r in stage(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()}
    out = stage(spark, clashing, SF)
    assert out.columns == clashing.columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == plain, name
    unchanged(rows)


def test_operators_keep_the_values_of_other_columns(spark, clashing):
    bench, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "labels"))
    unchanged(jaccard.without_near_copies(clashing).collect())
    unchanged(decontaminate.without_contaminated(clashing, bench).collect())
    unchanged(secrets_scan.redacted(clashing).collect())
    unchanged(resample.selected(clashing, labels).collect())
    spelled = pieces.decode(pieces.encode(clashing.limit(30))).collect()
    unchanged(spelled)
    assert all(r.decoded == r.text for r in spelled)
