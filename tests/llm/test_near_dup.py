import random

import numpy as np
import pytest

from armlens.llm import near_dup


def brute(rows, width, percent):
    """Row -> (set size, component, kept), by comparing all sets."""
    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] is None or rows[j][0] is None or not a or not b:
                continue
            if 100 * len(a & b) >= percent * len(a | b):
                comp[find(i)] = find(j)
    low = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            low[find(i)] = min(low.get(find(i), name), name)
    out = []
    for i, (name, _) in enumerate(rows):
        c = low[find(i)] if name is not None else None
        out.append((name, len(sets[i]), c, True if name is None else name == c))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def grown(n, seed, steps):
    """Chains of edited copies: neighbours are similar, ends are not."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(n):
        text = rnd.choices(words, k=rnd.randint(3, 60))
        for _ in range(rnd.randint(1, steps)):
            rows.append(" ".join(text))
            text = list(text)
            text[rnd.randrange(len(text))] = rnd.choice(words)
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width", [4, 5])
def test_matches_brute_force(make_docs, width):
    rows = grown(25, 1, 12)
    assert result(near_dup.near_duplicates(make_docs(rows), width=width)) == brute(rows, width, 80)


def test_large_group_uses_the_long_list_path(make_docs):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = rnd.choices(words, k=80)
    rows = []
    for i in range(220):  # more than LONG members share the posting lists
        text = list(base)
        for _ in range(rnd.randint(0, 6)):
            text[rnd.randrange(80)] = rnd.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(base)) for i in range(90)]  # exact copies
    assert result(near_dup.near_duplicates(make_docs(rows))) == brute(rows, 4, 80)


def test_edges(make_docs, edge_rows):
    assert result(near_dup.near_duplicates(make_docs(edge_rows))) == brute(edge_rows, 4, 80)
    assert near_dup.near_duplicates(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        near_dup.near_duplicates(make_docs([]), percent=70)


def test_keep_one(make_docs):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (2, "other words stay here now"), (2, "other words stay here now"),
            (None, "a b c d e f"), (None, "a b c d e f"), (9, ""), (8, None), (8, None)]
    docs = make_docs(rows)
    kept = near_dup.keep_one(docs).select("row.*")
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "8", "9", "None", "None"]


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r["node"]: r["comp"] for r in near_dup.components(links).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[102] == 100 and got[100] == 100


def near_copies(n, edits, seed, words=400, length=80):
    rnd = random.Random(seed)
    names = [f"w{i}" for i in range(words)]
    base = rnd.choices(names, k=length)
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rnd.randint(*edits)):
            text[rnd.randrange(length)] = rnd.choice(names)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("edits", [(0, 4), (2, 7)])
def test_dealt_lists_and_shared_blocks_match_brute_force(make_docs, monkeypatch, edits):
    monkeypatch.setattr(near_dup, "PART", 40)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rows = list(enumerate(near_copies(260, edits, 5)))
    assert result(near_dup.near_duplicates(make_docs(rows))) == brute(rows, 4, 80)


def test_no_task_holds_a_hot_list(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    monkeypatch.setattr(near_dup, "PART", 50)
    kind = "key long, own boolean, id long, n int, at int, comp long"
    closed = [(1, True, i, 9, 0, 5) for i in range(400)]
    few = [(2, True, i, 9, 0, 5 if i > 3 else i) for i in range(400)]
    apart = [(3, True, i, 9, 0, i) for i in range(200)]
    foreign = [(4, False, i, 9, 0, i) for i in range(50)]
    one = lambda rows: near_dup.open_blocks(spark.createDataFrame(rows, kind)).collect()
    assert one(closed) == [] and one(foreign) == []
    for rows in (few, apart):
        got, at = one(rows), {r[2]: r[5] for r in rows}
        held, met = {}, set()
        for r in got:
            held.setdefault(r["key"], ([], []))[r["left"]].append(r["id"])
        assert max(len(a) + len(b) for a, b in held.values()) <= 80
        for members, lefts in held.values():
            met |= {(min(a, b), max(a, b)) for a in members for b in lefts if at[a] != at[b]}
        assert met == {(a, b) for a in at for b in at if a < b and at[a] != at[b]}
    assert len(one(few)) < 600  # a few stragglers do not multiply the list
    postings = spark.createDataFrame([(7, i) for i in range(500)] + [(8, i) for i in range(30)], "key long, id long")
    parts = near_dup.dealt(postings).groupBy("list", "key").count().collect()
    assert max(r["count"] for r in parts if r["list"] == 7) <= 90 and sum(r["count"] for r in parts) == 530
    assert [r["key"] for r in parts if r["list"] == 8] == [8]


def test_a_group_of_near_misses_leaves_no_pairs(spark, make_docs, monkeypatch):
    """Hundreds of documents near one another but mostly below the similarity: rows out of the blocks stay few."""
    monkeypatch.setattr(near_dup, "LIKELY", 41)  # no pair is found by a leader: all is left to the blocks
    rows = list(enumerate(near_copies(300, (4, 8), 11)))
    held = {}
    keep = near_dup.staged

    def watch(df, name):
        held[name] = keep(df, name)
        return held[name]
    monkeypatch.setattr(near_dup, "staged", watch)
    assert result(near_dup.near_duplicates(make_docs(rows))) == brute(rows, 4, 80)
    assert held["near-more"].count() < 2 * len(rows) and held["near-involved"].count() > 0


def test_common_counts():
    rnd = random.Random(4)
    for _ in range(50):
        one = np.unique(np.array(rnd.choices(range(60), k=rnd.randint(1, 40)), np.uint64))
        sets = [np.unique(np.array(rnd.choices(range(70), k=rnd.randint(1, 40)), np.uint64)) for _ in range(rnd.randint(1, 9))]
        assert near_dup._common(one, sets).tolist() == [len(np.intersect1d(one, s)) for s in sets]


def test_components_that_do_not_settle_raise(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)], "a long, b long")
    with pytest.raises(RuntimeError):
        near_dup.components(links, rounds=1)
