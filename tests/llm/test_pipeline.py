import corpus_pipeline
from tests.llm.conftest import rows
from tidemark.llm.common import connected_components, save

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, SF), "test")
        seen.append((name, docs.count()))
        if name != "packing":
            assert docs.columns == names
    assert [n for n, _ in seen] == ["language_id", "near_duplicates", "decontamination",
                                    "secret_scan", "packing"]
    assert seen[0][1] >= 195 and seen[1][1] >= 180 and seen[2][1] == seen[3][1] > 160
    assert corpus_pipeline.run(spark, SF).count() == seen[-1][1]


def test_odd_rows_pass_every_stage(spark, odd, clashing, empty):
    for frame in (odd, clashing, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            if name != "packing":
                assert out.columns == frame.columns
            n = out.count()
            assert n <= frame.count() or name == "packing"
    kept = corpus_pipeline.near_duplicates(spark, odd, SF)
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(8) == 0 and ids.count(7) == 1 and ids.count(None) == 2
    left = corpus_pipeline.secrets_redacted(spark, odd, SF)
    assert rows(left) == rows(odd)


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}
