from __future__ import annotations

import zlib
from collections import Counter

import pytest

from inkwell.llm.sharding import bucket_offsets, shard_documents, shuffled_shards, write_shards

from . import helpers as H


def held(df):
    return sorted(map(tuple, df.collect()), key=str)


def places(rows, shards):
    """Slots by shard, checked: gapless from 0, and sizes that differ by one at most."""
    by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in by.values())
    assert sum(map(len, by.values())) == len(rows) and max(map(len, by.values())) - min(map(len, by.values())) <= 1


@pytest.mark.parametrize("bucket_bytes", [200, 4_000_000])
def test_every_row_has_one_place(spark, bucket_bytes):
    rows = H.corpus() * 3
    docs = spark.createDataFrame(rows, H.SCHEMA).repartition(5).cache()
    found = shard_documents(docs, 40, bucket_bytes=bucket_bytes).collect()
    places(found, 40)
    expected = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == expected
    assert {(r.law, r.grown_shard) for r in found} == {("rows", None)}
    assert held(shard_documents(docs, 40, bucket_bytes=bucket_bytes)) == sorted(map(tuple, found), key=str)


def test_order_is_random_and_follows_the_seed(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "16L as size").repartition(3)
    one, two = ({r.doc_id: (r.shard, r.slot) for r in shuffled_shards(docs, 10, seed=s, bucket_bytes=20_000).collect()} for s in (1, 2))
    assert one != two
    for k in range(10):  # ids of each tenth are spread over all shards alike: 200 expected, standard deviation 13
        spread = Counter(one[i][0] for i in range(2000 * k, 2000 * k + 2000))
        assert all(130 < spread[s] < 270 for s in range(10))
    order = sorted(one, key=one.get)
    rises = sum(a < b for a, b in zip(order, order[1:]))
    assert 9700 < rises < 10300  # a run of ids in order would give more


def test_copies_fill_no_bucket(spark):
    docs = spark.createDataFrame([(None, "copy")] * 3000 + [(i, "x") for i in range(10)], "doc_id bigint, text string").repartition(4)
    found = shard_documents(docs, 7, bucket_bytes=2000).collect()
    places(found, 7)
    assert Counter((r.doc_id, r.size) for r in found) == Counter([(None, 20)] * 3000 + [(i, 17) for i in range(10)])


def test_odd_tables(spark):
    big = 1 << 60
    rows = [(big + 1, 20, 5, "a", None), (None, 20, 6, None, [1]), (big + 3, None, 7, "b", [None]), (big + 3, 20, None, "b", []), (0, 10**9, 1, "c", [2])]
    docs = spark.createDataFrame(rows, "doc_id bigint, size bigint, slot int, `held.row` string, bucket array<int>")
    found = shuffled_shards(docs, 3).collect()
    places(found, 3)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in found), key=str) == sorted(((r[0], r[1], r[3], r[4]) for r in rows), key=str)
    assert found[0].asDict().keys() == {"doc_id", "size", "held.row", "bucket", "shard", "slot"}
    assert shuffled_shards(docs.limit(0), 3).count() == 0
    places(shuffled_shards(docs, 40).collect(), 40)
    long = spark.createDataFrame([(1, "é" * 10_000_000), (2, None)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.size) for r in shard_documents(long, 2).collect()) == [(1, 20_000_016), (2, 16)]
    with pytest.raises(ValueError):
        shuffled_shards(docs, 0)


def test_offsets(spark):
    counts = [(b, (b * 7) % 5 + 1) for b in range(0, 200, 3)]
    found = {r.bucket: r.before for r in bucket_offsets(spark.createDataFrame(counts, "bucket bigint, n bigint")).collect()}
    assert found == {b: sum(n for c, n in counts if c < b) for b, _ in counts}


def test_written_shards(spark, tmp_path):
    rows = H.corpus()
    docs = spark.createDataFrame(rows, H.SCHEMA).withColumn("size", H_size())
    write_shards(docs, f"{tmp_path}/out", 4, bucket_bytes=1000)
    back = spark.read.parquet(f"{tmp_path}/out")
    places(back.collect(), 4)
    assert held(back.select(*docs.columns)) == held(docs)


def H_size():
    from inkwell.llm.sharding import record_size

    return record_size()


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(H.corpus(), H.SCHEMA)
    plan = shard_documents(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
