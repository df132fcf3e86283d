from __future__ import annotations

from . import helpers as H


def test_stages(spark, tmp_path):
    import corpus_pipeline as P

    rows = H.corpus(120, seed=9)
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    near = spark.read.parquet(f"{tmp_path}/near_dedup")
    kept = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/language_id").collect()]
    assert {r["doc_id"] for r in near.collect()} == {d for d, (_, c) in H.near_groups(kept, 5).items() if d == c}
    assert P.run(spark, str(tmp_path)).count() > 0
