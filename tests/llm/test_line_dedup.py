import random

import xxhash
from pyspark.sql import functions as F

from armlens.llm import line_dedup as L


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _hash_string(s, seed=42):
    return _signed(xxhash.xxh64_intdigest(s.encode(), seed))


def _hash_long(v, seed):
    return _signed(xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed & (1 << 64) - 1))


def brute_chunks(text, alone=50):
    """Chunks (list of lines, counts) of a text."""
    if text is None:
        return []
    lines = text.split("\n")
    long = [len(x.encode().split()) >= alone for x in lines]
    h = [_hash_string(x) for x in lines]
    starts = [i for i in range(len(lines)) if i == 0 or long[i] or long[i - 1]
              or _hash_long(h[i], _hash_long(h[i - 1], 42)) % L.MODULUS == 0]
    out = []
    for a, b in zip(starts, starts[1:] + [len(lines)]):
        out.append((lines[a:b], sum(bool(x.strip(" \t\n\x0b\f\r")) for x in lines[a:b]) >= 2 or any(long[a:b])))
    return out


def brute(rows):
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        for k, (lines, counts) in enumerate(brute_chunks(rows[i][1])):
            if counts:
                first.setdefault("\n".join(lines), (rows[i][0], rows[i][1], k))
    for name, text in rows:
        cs = brute_chunks(text)
        goes = {k for k, (lines, counts) in enumerate(cs) if counts and first["\n".join(lines)] != (name, text, k)}
        keep = [x for k, (lines, _) in enumerate(cs) if k not in goes for x in lines]
        out.append((name, text if not goes else "\n".join(keep), sum(len(c[0]) for c in cs), len(goes)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["row"]["doc_id"], r["clean"], r["n_lines"], r["n_chunks"]) for r in df.collect()), key=str)


def corpus(seed=3):
    rnd = random.Random(seed)
    line = lambda: " ".join(rnd.choices([f"w{i}" for i in range(200)], k=rnd.randint(1, 12)))
    passages = [[line() for _ in range(rnd.randint(6, 14))] for _ in range(4)]
    wall = " ".join(rnd.choices([f"w{i}" for i in range(200)], k=70))
    rows = []
    for i in range(60):
        body = [line() for _ in range(rnd.randint(1, 12))]
        at = rnd.randint(0, len(body))
        if rnd.random() < 0.6:
            body[at:at] = rnd.choice(passages)
        if rnd.random() < 0.3:
            body.insert(rnd.randint(0, len(body)), wall)
        rows.append((i, "\n".join(body)))
    return rows


def test_matches_brute_force(make_docs):
    rows = corpus()
    want = brute(rows)
    assert sum(r[3] for r in want) > 30
    assert result(L.dedup_lines(make_docs(rows))) == want


def test_inserted_line_moves_no_far_boundary(spark):
    lines = [f"line number {i} of the text" for i in range(60)]
    texts = ["\n".join(lines), "\n".join(["new first line"] + lines)]
    cut = spark.createDataFrame([(t,) for t in texts], "t string").select(L.chunked(F.col("t")).alias("c")).collect()
    a, b = ({tuple(c["lines"]) for c in r["c"]} for r in cut)
    assert len(a & b) >= len(a) - 1


def test_long_line_repeats_alone(make_docs):
    wall = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "start one\n" + wall + "\nend one"), (2, "start two\n" + wall + "\nend two"), (3, wall)]
    got = {r["row"]["doc_id"]: r["clean"] for r in L.dedup_lines(make_docs(rows)).collect()}
    assert wall in got[1] and wall not in got[2] and got[3] == ""
    assert got[2] == "start two\nend two"


def test_edges(make_docs, edge_rows):
    rows = [r for r in edge_rows if r[0] is not None]
    docs = make_docs(rows)
    got = L.dedup_lines(docs)
    assert got.select("row.*").columns == docs.columns
    assert result(got) == brute(rows)
    two = "first line here\nsecond line here\nthird line here\nfourth one"
    same = L.dedup_lines(make_docs([(1, two), (1, two)])).collect()
    assert [r["clean"] for r in same] == [two, two]  # one document, given twice
    null_id = L.dedup_lines(make_docs([(None, two), (7, two)])).collect()
    assert {r["row"]["doc_id"]: r["clean"] == two for r in null_id}[7]
    assert L.dedup_lines(make_docs([])).count() == 0


def brute_passages(rows, least=50):
    """Per row the lines that lie in a run of several worded lines and ``least`` words which
    occurs verbatim in an earlier document, or earlier in the same one without overlap."""
    texts = [t.split("\n") for _, t in rows]
    size = [[len(x.encode().split()) for x in ls] for ls in texts]

    def is_passage(d, i, n):
        w = size[d][i:i + n]
        return sum(w) >= least and sum(x > 0 for x in w) >= 2

    places = {}
    for d, ls in enumerate(texts):  # rows in order of doc_id
        for i, x in enumerate(ls):
            places.setdefault(x, []).append((d, i))
    gone = [set() for _ in rows]
    for d, ls in enumerate(texts):
        for i, x in enumerate(ls):
            for e, j in places[x]:
                if (e, j) >= (d, i):
                    break
                n = 0
                while i + n < len(ls) and j + n < len(texts[e]) and ls[i + n] == texts[e][j + n] and (e < d or j + n < i):
                    n += 1
                if is_passage(d, i, n):
                    gone[d] |= set(range(i, i + n))
    return gone


def passage_corpus(seed=7):
    rnd = random.Random(seed)
    line = lambda: " ".join(rnd.choices([f"w{i}" for i in range(300)], k=rnd.randint(12, 40)))
    passages = [[line() for _ in range(n)] for n in (2, 2, 3, 3, 4, 5)]
    passages.append([line(), "", line(), line()])
    rows = []
    for i in range(50):
        body = [line() for _ in range(rnd.randint(1, 5))]
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(passages)
            a = rnd.randint(0, 1) if len(p) > 3 else 0
            at = rnd.randint(0, len(body))
            body[at:at] = p[a:]
        rows.append((i, "\n".join(body)))
    return rows


def test_passages_of_few_lines_match_brute_force_on_runs(make_docs):
    rows = passage_corpus()
    lonely = [{j for j, c in enumerate(brute_marks) if c} for brute_marks in _chunk_marks(rows)]
    gone = [a | b for a, b in zip(brute_passages(rows), lonely)]
    want = {name: "\n".join(x for j, x in enumerate(t.split("\n")) if j not in g) for (name, t), g in zip(rows, gone)}
    got = {r["row"]["doc_id"]: r for r in L.dedup_passages(make_docs(rows)).collect()}
    assert {k: r["clean"] for k, r in got.items()} == want
    assert [got[name]["n_removed"] for name, _ in rows] == [len(g) for g in gone]
    assert sum(len(g - c) for g, c in zip(gone, lonely)) > 30  # lines that chunks leave


def _chunk_marks(rows):
    """Per row, for each line, whether it lies in a repeated chunk that goes."""
    seen, out = set(), []
    for _, text in rows:
        marks = []
        for lines, counts in brute_chunks(text):
            key = "\n".join(lines)
            marks += [counts and key in seen] * len(lines)
            if counts:
                seen.add(key)
        out.append(marks)
    return out


def test_passage_of_two_lines_goes_whatever_stands_around_it(make_docs):
    two = "\n".join(" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(i, f"start {i}\n{two}\nend {i}") for i in range(12)]
    got = {r["row"]["doc_id"]: r["clean"] for r in L.dedup_passages(make_docs(rows)).collect()}
    assert got == {0: rows[0][1]} | {i: f"start {i}\nend {i}" for i in range(1, 12)}


def test_overlapping_repeats_keep_the_first_whole(make_docs):
    x = " ".join(f"w{i}" for i in range(30))
    got = L.dedup_passages(make_docs([(1, "\n".join([x] * 3)), (2, "\n".join(["other", x, x]))])).collect()
    assert {r["row"]["doc_id"]: r["clean"] for r in got} == {1: "\n".join([x] * 3), 2: "other"}
