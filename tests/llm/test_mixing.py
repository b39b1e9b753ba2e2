import math
from collections import Counter

from pyspark.sql import functions as F

from armlens.llm import mixing


def brute_targets(sizes: dict, epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > epochs * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = float(epochs * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    return target


def test_targets_and_taken(make_docs, small_texts):
    rows = small_texts + [(9000, "null source " * 30, None), (9001, "tiny", "aaa")]
    got = mixing.mix(make_docs(rows)).collect()
    sizes, doc = Counter(), {r[0]: len((r[1] or "").encode().split()) for r in rows}
    for r in rows:
        sizes[r[2]] += doc[r[0]]
    want = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert r["size"] == doc[r["id"]] and r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] == r["size"] * len(r["draws"]) <= 3 * r["size"]
        assert all(0 <= s < 16 for s in r["draws"])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(want[s] - taken[s]) <= max(doc[r[0]] for r in rows if r[2] == s) / 2 + 1e-6


def test_reruns_and_partitioning_agree(make_docs, small_texts):
    key = lambda df: sorted((r["id"], r["taken"], tuple(r["draws"])) for r in df.collect())
    assert key(mixing.mix(make_docs(small_texts, 2))) == key(mixing.mix(make_docs(small_texts, 5)))


def test_capped_chain():
    assert brute_targets({"a": 1, "b": 100, "c": 100})["a"] == 3


def test_capped_chain_in_spark(spark):
    sizes = {"a": 1, "b": 10, "c": 1000, "d": 2}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9) for s in sizes)


def test_edges(make_docs, edge_rows):
    got = mixing.mix(make_docs(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(make_docs([])).count() == 0
    blank = mixing.mix(make_docs([(1, None), (2, "")])).collect()
    assert [r["taken"] for r in blank] == [0, 0]


def test_split_is_hypergeometric(spark):
    """Mean and range of the drawn left share over many seeded uniforms."""
    frame = spark.range(4000).select(
        mixing._hypergeometric(F.lit(30), F.lit(100), F.lit(40), (F.col("id") + 0.5) / 4000).alias("x"))
    values = [r["x"] for r in frame.collect()]
    weight = [math.comb(40, k) * math.comb(60, 30 - k) for k in range(31)]
    count = Counter(values)
    for k in range(31):
        assert abs(count[k] / 4000 - weight[k] / math.comb(100, 30)) < 1e-3


def test_tree_splits_quotas_exactly(spark):
    quotas = spark.createDataFrame([(0, 100), (1, 7), (2, 0)], "source_no int, draws long")
    got = {r["source_no"]: [s["start"] for s in r["starts"]] for r in mixing.shard_quotas(quotas, 5, 3).collect()}
    for s, total in ((0, 100), (1, 7), (2, 0)):
        assert len(got[s]) == 5 and got[s][0] == 0 and got[s] == sorted(got[s]) and got[s][-1] <= total


def test_mixed_rows_repeat_as_drawn(make_docs, small_texts):
    docs = make_docs(small_texts)
    rows = mixing.mixed_documents(docs)
    assert rows.select("row.*").columns == docs.columns
    drawn = Counter(r["id"] for r in rows.select("row.doc_id").withColumnRenamed("doc_id", "id").collect())
    assert drawn == Counter({r["id"]: len(r["draws"]) for r in mixing.mix(docs).collect() if r["draws"]})
