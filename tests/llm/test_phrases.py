import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from armlens.llm import phrases as P

ASCII_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, min_count=10, top=2000, covered=50):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if " " in p and a >= min_count}
        scored = []
        for p, a in cand.items():
            w = p.split(" ")
            cuts = [(10**6 * a * a // (c[" ".join(w[:k])] * c[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            if any(100 * b >= covered * a for q, b in cand.items()
                   if q != p and f" {p} " in f" {q} "):
                continue
            scored.append((-score, -a, p.encode(), p, c[" ".join(w[:k])], c[" ".join(w[k:])]))
        for rank, (s, a, _, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p, -a, left, right, n[lang], -s))
    return sorted(out)


def make(spark, rows, partitions=3):
    df = spark.createDataFrame([(k, t, g, "x", "x", "x") for k, (g, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, word string, pair string, id string")
    return df.repartition(partitions) if rows else df


def got(df):
    return sorted(map(tuple, df.collect()))


def random_rows(seed, n):
    rnd = random.Random(seed)
    vocab = ["new", "York", "york", "Times", "a\x01", "a", "über", "ÜBER", "x-y", "😀", "the", "the"]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\x0b"]
    rows = [(rnd.choice(["en", "en", "de", None]), "".join(rnd.choice(vocab) + rnd.choice(seps) for _ in range(rnd.randrange(40))))
            for _ in range(n)]
    return rows + [("en", "San Francisco Bay " * 30), ("en", "san francisco bay. " * 12), ("en", "golden gate " * 11)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    rows = random_rows(seed, 150)
    assert got(P.mine(make(spark, rows))) == brute(rows)
    monkeypatch.setattr(P, "CHUNK_BYTES", 300)
    assert got(P.mine(make(spark, rows, 5), min_count=3, top=7, covered_percent=80)) == brute(rows, 3, 7, 80)


def test_edges(spark):
    edge = [("en", None), (None, ""), ("en", " \n\t "), ("en", "one"), ("en", "x" * 5000), ("de", "a b c d")]
    assert got(P.mine(make(spark, edge))) == []
    assert got(P.mine(make(spark, []))) == []
    rows = edge + [("en", "alpha beta")] * 10 + [(None, "alpha beta")] * 6 + [("und", "alpha beta")] * 4 + \
        [("xx", "long text here " * 20_000)]
    assert got(P.mine(make(spark, rows))) == brute(rows)
    assert ("und", 1, "alpha beta", 10, 10, 10, 20, 1_000_000) in brute(rows)


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, big + 1, big + 3)], "a long, l long, r long")
    assert df.select(P._score("l", "r")).first()[0] == 10**6 * big * big // ((big + 1) * (big + 3))


def test_runs_are_sorted_and_counted():
    rng = np.random.default_rng(3)
    ids = rng.integers(-1, 4, 500)
    pairs, n, firsts, thirds, m = P._runs(ids)
    want2, want3 = Counter(), Counter()
    for i in range(499):
        if min(ids[i:i + 2]) >= 0:
            want2[int(ids[i]) << 32 | int(ids[i + 1])] += 1
        if i < 498 and min(ids[i:i + 3]) >= 0:
            want3[int(ids[i]) << 32 | int(ids[i + 1]), int(ids[i + 2])] += 1
    assert dict(zip(pairs.tolist(), n.tolist())) == want2 and (np.diff(pairs) > 0).all()
    assert dict(zip(zip(firsts.tolist(), thirds.tolist()), m.tolist())) == want3
    for short in ([], [0], [1, 2], [-1, -1, -1]):
        assert len(P._runs(np.array(short, np.int64))) == 5


def test_query_matches_oracle(spark):
    import duckdb

    from armlens.llm.oracle import oracle_queries
    from armlens.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(oracle_queries()["op12_phrases"])
    names = [d[0] for d in want.description]
    df = QUERIES["op12_phrases"](spark, sf)
    assert sorted(df.columns) == sorted(names)
    rows = got(df.select(*names))
    assert rows == sorted(want.fetchall()) and len(rows) > 100
