"""The pipeline's stages on a small table: each keeps what brute force keeps of its own input."""

import corpus_pipeline
import pytest
from palimpsest.llm.queries import QUERIES


def test_stages(spark, documents, tmp_path):
    texts = [f"doc {i} " + " ".join(f"w{i}x{k}" for k in range(60)) for i in range(30)]
    texts += [texts[0], texts[1] + " tail", None, "", "bench a b c d e f g h i j k"]
    docs = documents(texts)
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, frame = [], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, str(tmp_path))
        if k < 4:
            assert frame.columns == docs.columns
            frame.write.parquet(str(tmp_path / f"s{k}"))
            frame = spark.read.schema(frame.schema).parquet(str(tmp_path / f"s{k}"))
            kept.append({r.doc_id for r in frame.collect()})
    everything = set(range(len(texts)))
    assert kept[0] == everything
    assert kept[1] == everything - {0, 32}  # copies: the largest id stays; null is the empty text
    assert kept[2] == kept[1] - {31}  # near copies: the smallest id stays
    assert kept[3] == kept[2] - {34}
    assert {r.doc_id for r in frame.collect()} == kept[3]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_without_labels_everything_stays(spark, documents, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(["a b c", None, "", "d"], [1, 2, None, 1])
    assert sorted(map(str, corpus_pipeline.good_documents(spark, docs, str(tmp_path)).collect())) == sorted(map(str, docs.collect()))


def test_all_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_decontamination", "op3_url_filters", "op9_license_scans", "op12_conversation_repair"])
def test_sql(spark, name):
    from pathlib import Path

    duckdb = pytest.importorskip("duckdb")
    from palimpsest.llm.oracles import ORACLES

    from check import rows_of

    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for file in folder.glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from read_parquet('{file}')")
    frame = QUERIES[name](spark, str(folder))
    relation = connection.sql(ORACLES[name])
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(relation.columns, relation.fetchall())
