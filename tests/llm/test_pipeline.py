import corpus_pipeline
from matchvault.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import SF


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() <= rows
    copies = {c for _, _, c in brute.jaccard_components([tuple(r) for r in docs.select("doc_id", "text").collect()])}
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SF).collect()} == copies
    last = corpus_pipeline.run(spark, SF).collect()
    assert last and all(r.lossless and r.n_pieces == len(r.pieces) for r in last)


def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
