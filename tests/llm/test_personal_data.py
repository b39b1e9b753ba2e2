import hashlib
import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from armlens.llm import personal_data as D
from armlens.llm.queries import QUERIES, personal_digest

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


CARDS = ["4465758382889437", "4316522678525456", "4111 1111 1111 1111", "4111-1111-1111-1111"]


def corpus(n=400, seed=4):
    rnd = random.Random(seed)
    number = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))

    def card():
        body = "4" + number(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def piece():
        return rnd.choice([
            lambda: f"a.b{number(2)}@mail{rnd.randrange(9)}.example.com", lambda: ".".join(str(rnd.randrange(256)) for _ in range(4)),
            card, lambda: f"+1 ({number(3)}) 555-{number(4)}", lambda: number(rnd.randrange(1, 9)), lambda: f"no{number(3)}",
            lambda: "4" + number(14) + "x", lambda: f"{number(2)}.{number(2)}"])()

    words = "the of and house river table so on it was".split()
    return [(i, " ".join(rnd.choice(words) if rnd.random() < 0.8 else piece() + " " + rnd.choice(words) for _ in range(40)))
            for i in range(n)]


def test_base_spans_equal_plain_patterns():
    rnd = random.Random(1)
    alphabet = "0123456789" * 3 + "@@..++-- ()ab,é😀\n"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(4000)]
    texts += [t for _, t in corpus(100)] + ["a@b.c@d.e x@y@z.com @y.a@z.com q@y.a@z.com", "1.2.3.4.5.6.7.8 0001.2.3.255 1.2.3.256"] + CARDS
    texts += ["x@" + a + b for a in ("a.b", "a.", "-.-", "a..b") for b in ("", ".", "@c.d", " 1")]
    assert sum(len(brute(t)) for t in texts) > 300
    for t in texts:
        assert D.base_spans(t)[0] == brute(t), t


def test_long_texts_take_linear_time():
    for t in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + "(" * 300_000, "a@" * 150_000, "a@b" + "c" * 300_000,
              "1 " * 200_000, "a.b" * 100_000 + "@"):
        D.base_spans(t)
        D._TOKEN.findall(t)


def exact(g, field):
    """Marginals by summing over all labellings."""
    n = len(g.features)
    left, right = set(g.chain[:, 1].tolist()), set(g.chain[:, 0].tolist())
    total = np.zeros((n, D.LABELS))
    options = [[k for k in range(D.LABELS) if g.allowed[i, k]] for i in range(n)]
    for y in itertools.product(*options):
        s = sum(field.local[g.features[i], y[i]].sum() for i in range(n))
        s += sum(field.chain[0, y[i]] for i in range(n) if i not in left)
        s += sum(field.chain[y[i], 0] for i in range(n) if i not in right)
        for e, p in ((g.chain, field.chain), (g.same, field.same), (g.similar, field.similar)):
            s += sum(p[y[i], y[j]] for i, j in e.tolist())
        for i in range(n):
            total[i, y[i]] += np.exp(s)
    return total / total.sum(axis=1, keepdims=True)


def random_field(seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return D.Field(rng.normal(0, scale / 4, (1 << D.BITS, D.LABELS)), rng.normal(0, scale, (D.LABELS, D.LABELS)),
                   D._agreement(0.8, 0.3), D._agreement(0.4, 0.1))


def test_message_passing_equals_enumeration_on_trees_and_comes_near_on_loops():
    for seed, text in enumerate(["12 345 6", "1.2.3.4 word 12 (345)", "12 345 word 67-8 word +9", "x@y.zz 12 345"]):
        g, field = D.graph(text), random_field(seed)
        if len(g.same) or len(g.similar):
            g.same, g.similar = g.same[:0], g.similar[:0]
        assert np.allclose(D.marginals(g, field, rounds=60), exact(g, field), atol=1e-9)
    # one distant skip edge between two chains is still a tree
    g, field = D.graph("4444 12 word word 4444 x9"), random_field(9)
    g.similar = g.similar[:0]
    assert len(g.same) == 1 and len(g.chain) == 2
    assert np.allclose(D.marginals(g, field, rounds=60), exact(g, field), atol=1e-9)
    g = D.graph("4444 123 word 4444 123")  # a loop: chain, same and similar edges
    field = random_field(3, 0.3)
    assert len(g.same) == 2 and len(g.similar) == 2
    assert np.abs(D.marginals(g, field, rounds=100) - exact(g, field)).max() < 0.05


def test_skip_edges_carry_evidence():
    """The second mention has no local evidence of its own: only the skip edge tells it."""
    g = D.graph("+1 word 55555555 word 55555555")
    local = np.zeros((1 << D.BITS, D.LABELS))
    g.features[:] = 0
    g.features[1] = 1
    local[1, 5] = 1.0  # 14 features: strong evidence of a card at the first mention
    without = D.Field(local, np.zeros((9, 9)), D._agreement(0, 0), D._agreement(0, 0))
    with_skip = D.Field(local, np.zeros((9, 9)), D._agreement(3, 0), D._agreement(0, 0))
    assert D.marginals(g, with_skip)[2, 5:7].sum() > D.marginals(g, without)[2, 5:7].sum() + 0.3


def fitted(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return D.train(docs, steps=120)


def test_training_rows_and_held_out_accuracy(spark):
    rows = corpus(500)
    field = fitted(spark, rows[:350])
    right = known = entities = caught = 0
    for _, text in rows[350:]:
        g = D.graph(text)
        if not g.spans:
            continue
        want = D.token_labels(g.spans, *D.base_spans(text))
        got = D.marginals(g, field).argmax(axis=1)
        known += (want >= 0).sum()
        right += ((want == got) & (want >= 0)).sum()
        entities += (want > 0).sum()
        caught += ((want > 0) & (want == got)).sum()
    assert entities > 300 and right / known > 0.97 and caught / entities > 0.97


def spans_of(df):
    return {r.row.doc_id: [(s.kind, r.row.text[s.start:s.end], s.base) for s in r.spans] for r in df.collect()}


def test_lost_spans_are_added_and_clean_texts_left_alone(spark):
    rows = corpus(300)
    field = fitted(spark, rows)
    planted = [(1000, "see 4465758382889437 4465758382889437 there"), (1001, "call +1 (743) 555-3824 4316522678525456 now"),
               (1002, "nothing here but 12 and 2024 and 3.14 words"), (1003, "pi 3.1415 in 1999-12-31 at 10:30, p. 55-60"),
               (1004, "é😀 4316522678525456 then +1 (310) 555-4510 4465758382889437 and 4465758382889437")]
    df = D.find(spark.createDataFrame(planted, "doc_id long, text string"), field, redacted=True)
    got = spans_of(df)
    assert got[1000] == [("card", "4465758382889437", False)] * 2
    assert ("card", "4316522678525456", False) in got[1001] and ("phone", "+1 (743) 555-3824", False) in got[1001]
    assert got[1002] == got[1003] == []
    assert ("card", "4316522678525456", True) in got[1004] and got[1004].count(("card", "4465758382889437", True)) == 1
    text = {r.row.doc_id: r.redacted for r in df.collect()}
    assert text[1000] == "see <CARD> <CARD> there" and text[1002] == planted[2][1]
    base = {i: [(k, t) for k, t, b in s if b] for i, s in spans_of(D.find(spark.createDataFrame(rows, "doc_id long, text string"), field)).items()}
    assert base == {i: [(D.KINDS[k], t[a:b]) for a, b, k in brute(t)] for i, t in rows}


def test_digest_of_the_query(spark, make_docs, edge_rows):
    rows = edge_rows + [(20, "a1@b.cd 1.2.3.4"), (21, "é 4465758382889437, +1 (310) 555-4510"), (20, "a1@b.cd 1.2.3.4")]
    got = personal_digest(D.find(make_docs(rows), None, keep=["doc_id"])).collect()
    want = []
    for i, t in rows:
        s = brute(t)
        text = ",".join(f"{D.KINDS[k]}:{a}:{b}" for a, b, k in s)
        want.append((i, *(sum(k == x for _, _, k in s) for x in range(4)), hashlib.sha256(text.encode()).hexdigest(), text))
    assert sorted(map(repr, (tuple(r)[:7] for r in got))) == sorted(map(repr, want))
    assert D.train(make_docs(edge_rows)) is None and D.train(make_docs([])) is None
    assert D.find(make_docs([]), None).count() == 0


def test_results_do_not_depend_on_batches(spark, monkeypatch):
    rows = corpus(120, seed=8)
    field = fitted(spark, rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(map(str, D.find(docs.coalesce(1), field).collect()))
    monkeypatch.setattr(D, "BLOCK_TOKENS", 1)
    many = sorted(map(str, D.find(docs.repartition(7), field).collect()))
    strip = lambda rows: [re.sub(r"p=[0-9.e-]+", "", r) for r in rows]
    assert strip(one) == strip(many)


def test_query_on_the_driver_table(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in QUERIES["op13_personal_data"](spark, sf).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        text = ",".join(f"{D.KINDS[k]}:{a}:{b}" for a, b, k in brute(t))
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert not text or all(x in got[i].spans.split(",") for x in text.split(","))
    assert F
