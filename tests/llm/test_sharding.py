import zlib
from collections import Counter

from pyspark.sql import functions as F

from armlens.llm import sharding as S


def test_rows_law(make_docs, small_texts):
    rows = [r[:2] for r in small_texts]
    got = S.assign_shards(make_docs(rows)).collect()
    text = dict(rows)
    assert sorted(r["doc_id"] for r in got) == sorted(text)
    count = Counter(r["shard"] for r in got)
    assert set(count) == set(range(16)) and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(count[s]))
    for r in got:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())


def test_reruns_agree_whatever_the_partitions(make_docs, small_texts):
    rows = [r[:2] for r in small_texts]
    key = lambda n: sorted(tuple(r) for r in S.assign_shards(make_docs(rows, n)).collect())
    assert key(1) == key(7)


def test_fisher_yates_is_a_uniform_permutation(spark):
    got = spark.range(6000).select(S.fisher_yates(F.lit(4), F.lit(9), F.col("id")).alias("p")).collect()
    count = Counter(tuple(r["p"]) for r in got)
    assert len(count) == 24 and all(sorted(p) == [0, 1, 2, 3] for p in count)
    assert all(170 < c < 340 for c in count.values())  # 250 each, five deviations


def test_many_buckets_and_equal_records(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(400)], "x long")
    got = S.shuffled_ranks(df, bucket_rows=16).collect()
    assert sorted(r["rank"] for r in got) == list(range(400))
    assert Counter(r["x"] for r in got) == Counter({i: 8 for i in range(50)})


def test_edges(make_docs, edge_rows):
    got = S.assign_shards(make_docs(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    assert [r["size"] for r in got if r["doc_id"] == 1] == [1] and [r["text_crc32"] for r in got if r["doc_id"] == 1] == [None]
    assert S.assign_shards(make_docs([])).count() == 0


def test_written_shards_hold_everything_in_slot_order(spark, make_docs, small_texts, tmp_path):
    docs = make_docs([r[:2] for r in small_texts]).select("doc_id", "text")
    S.write_shards(docs, str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(small_texts)
    assert Counter(r["shard"] for r in back.collect()) == Counter({s: len(small_texts) // 4 for s in range(4)})


def test_query_reports_on_written_shards_of_whole_rows(spark):
    import os
    from urllib.parse import urlparse

    from armlens.llm.queries import op10_sharding
    from armlens.session import ensure_checkpoint_dir
    root = os.path.join(urlparse(ensure_checkpoint_dir(spark)).path, "llm")
    listed = lambda: {f for f in os.listdir(root) if f.startswith("shards-")} if os.path.isdir(root) else set()
    before = listed()
    got = op10_sharding(spark, "/root/testdata/sf0.001").collect()
    new = listed() - before
    assert len(new) == 1
    back = spark.read.parquet(os.path.join(root, new.pop()))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert set(docs.columns) <= set(back.columns)
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    where = {r["doc_id"]: (r["shard"], r["slot"]) for r in back.collect()}
    assert where == {r["doc_id"]: (r["shard"], r["slot"]) for r in got}


def test_buckets_follow_bytes_as_well_as_rows(spark):
    df = spark.createDataFrame([(i, "x" * 10_000) for i in range(40)], "i long, t string")
    assert S.bucket_count(df, 512, 100_000) == 5 and S.bucket_count(df, 8, 1 << 40) == 5
    got = S.shuffled_ranks(df, bucket_bytes=50_000).collect()
    assert sorted(r["rank"] for r in got) == list(range(40)) and {r["i"] for r in got} == set(range(40))
