import hashlib

import numpy as np
from pyspark.sql import functions as F

from armlens.llm import fill_middle as M


def brute(doc_id, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in M.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def rows_of(df):
    df = df.withColumn("restored", M.restore(F.col("output"), F.col("form")))
    return [((r.row.doc_id, r.row.text), (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.restored)
            for r in df.collect()]


def check(docs, rows):
    got = rows_of(M.transform(docs))
    assert sorted(repr(g[0]) for g in got) == sorted(repr(r[:2]) for r in rows)
    for (doc_id, text), found, restored in got:
        assert found == brute(doc_id, text) and restored == (text or "")
    return got


def test_matches_brute_force(spark, make_docs, small_texts):
    odd = ["añ😀ß漢" * 50, "\x00\x7f\x80߿ࠀ￿𐀀\U0010ffff" * 9, "😀", "é", "ab<", "<", "<P", "x<S" * 30, "in <M> it", "<P>",
           "S>" * 20, "漢字" * 70_000 + "z"]
    rows = [r[:2] for r in small_texts] + [(10_000 + 7 * k + j, t) for k, t in enumerate(odd) for j in range(4)]
    got = check(make_docs(rows), rows)
    assert {g[1][1] for g in got} == {"plain", "psm", "spm"}
    assert rows_of(M.transform(make_docs(rows, 1)))[0][1] is not None


def test_edges(spark, make_docs, edge_rows):
    check(make_docs(edge_rows), edge_rows)
    assert M.transform(make_docs([])).count() == 0
    kept = M.transform(make_docs(edge_rows), keep=["doc_id", "row", "key"])
    assert kept.columns == ["row", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert kept.select("row.*").columns == ["doc_id", "row", "key"]


def test_rank_and_select_on_all_alignments():
    rng = np.random.default_rng(5)
    alphabet = ["a", "é", "漢", "😀", "\x00"]
    for length in range(0, 40):
        text = "".join(alphabet[k] for k in rng.integers(0, 5, length))
        data = np.frombuffer(text.encode(), np.uint8)
        units = M.Units(data)
        ends = np.cumsum([0] + [len(c.encode()) for c in text])
        assert units.select(np.arange(length + 1)).tolist() == ends.tolist()
        assert units.rank(ends).tolist() == list(range(length + 1))


def test_other_sentinels_and_shares(spark, make_docs):
    rows = [(i, f"text <P> number. {i}") for i in range(300)]
    own = ("<.pre|>", "<(suf>", "[mid")
    df = M.transform(make_docs(rows), sentinels=own, fim_percent=100, spm_percent=50, seed=9)
    df = df.withColumn("back", M.restore(F.col("output"), F.col("form"), own))
    got = df.collect()
    assert all(r.back == r.row.text and r.form != "plain" for r in got)
    assert 100 < sum(r.form == "spm" for r in got) < 200


def test_query_matches_oracle(spark):
    import duckdb

    from armlens.llm.oracle import oracle_queries
    from armlens.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(oracle_queries()["op11_fill_middle"])
    names = [d[0] for d in want.description]
    df = QUERIES["op11_fill_middle"](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())
