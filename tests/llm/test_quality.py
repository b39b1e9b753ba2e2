import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from armlens.llm import quality as Q


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    c = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = set()
    for k in range(len(w) - 4):
        if c[tuple(w[k:k + 5])] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, r = len(w), len(covered)
    return (n, sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text or ""), len(lines) - len(set(lines)), r,
            n < 10 or 100 * r > 20 * n)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def grams(text):
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    longs = lambda v, seed: signed(xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed & (1 << 64) - 1))
    return [x % Q.BUCKETS for x in h + [longs(b, longs(a, 42)) for a, b in zip(h, h[1:])]]


def test_base_columns_and_scores_match_brute_force(spark, make_docs, small_texts):
    rows = small_texts[:80] + [(900 + k, t) for k, t in enumerate(
        ["a b c d e " * 3, "x " * 40, "one two three four five six one two three four five seven " * 2,
         "l1 a\nl1 a\n \n\nl2\nl1 a", "### $$$ <b>|&*%"])]
    docs = make_docs(rows)
    trusted = {r[0] for r in rows if r[0] % 3 == 0}
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    ratios = Q.log_ratios(docs, ids)
    raw, good = Counter(), Counter()
    for r in rows:
        raw.update(grams(r[1]))
        if r[0] in trusted:
            good.update(grams(r[1]))
    share = sum(good.values()) / sum(raw.values())
    table = {b: math.log((good[b] + Q.PRIOR) / (raw[b] * share + Q.PRIOR)) for b in raw}
    assert all(math.isclose(ratios[b], v, abs_tol=1e-9) for b, v in table.items())
    for r, text in ((r, dict((x[0], x[1]) for x in rows)[r["doc_id"]]) for r in Q.score_documents(docs, ratios).collect()):
        assert tuple(r[f] for f in FIELDS) == base(text)
        g = grams(text)
        want = sum(table[b] for b in g) / max(1, len(g))
        assert math.isclose(r["score"], want, abs_tol=1e-5)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= -0.15)


def test_junk_is_rejected(spark, make_docs):
    clean = " ".join(f"alpha{i % 40} beta{i % 23}" for i in range(60))
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 97}" for k in range(50))) for i in range(60)]
    rows += [(100 + i, " ".join(f"w{(i * 7 + k * k) % 97}***" for k in range(50))) for i in range(10)]
    docs = make_docs(rows)
    ids = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    got = {r["doc_id"]: r["kept"] for r in Q.score_documents(docs, Q.log_ratios(docs, ids)).filter("not base_failed").collect()}
    assert not any(v for i, v in got.items() if i >= 100) and all(v for i, v in got.items() if i < 100)
    assert clean


def test_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    none = spark.createDataFrame([], "doc_id long")
    ratios = Q.log_ratios(docs, none)
    assert not any(ratios)
    got = Q.score_documents(docs, ratios).collect()
    assert len(got) == len(edge_rows) and all(r["score"] == 0 for r in got)
    for r in got:
        if r["n_words"] == 0:
            assert r["base_failed"] and r["kept"] is False and r["word_chars"] == 0
    assert Q.score_documents(make_docs([]), Q.log_ratios(make_docs([]), none)).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    assert [r[0] for r in Q.trusted_ids(labels).collect()] == [2]


def test_repeated_words_on_hand_made_rows(spark):
    texts = ["a b c d e f g", "a b c d e a b c d e", "a b c d e x a b c d e", "a a a a a a", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    h = F.transform(Q.words(F.col("t")), lambda w: F.xxhash64(w))
    got = [r[0] for r in df.select(Q.repeated_words(h)).collect()]
    assert got == [base(t)[4] for t in texts]


def test_every_trusted_document_is_counted(spark):
    n = 60_000
    docs = spark.range(2 * n).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n, "good words").otherwise("bad words").alias("text"))
    ratios = Q.log_ratios(docs, spark.range(n).select(F.col("id").alias("doc_id")))
    # half of all grams are trusted; "good" is in trusted texts only
    assert math.isclose(max(ratios), math.log((n + Q.PRIOR) / (n / 2 + Q.PRIOR)), rel_tol=1e-9)


def test_counting_hashes_a_text_once(spark, make_docs):
    """No filter on the size of the exploded array may be pushed below the hashing."""
    docs = make_docs([(1, "a b c"), (2, None), (3, "")])
    grams = Q._hashed(docs, "doc_id", "text").select("doc_id", Q.n_grams(F.col("h")).alias("buckets"))
    counted = Q.bucket_counts(grams, "raw")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in "".join(x for x in plan.split("\n") if "Filter" in x)
    assert sum(r["raw"] for r in counted.collect()) == 5
