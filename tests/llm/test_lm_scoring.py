import math
import random
import zlib
from collections import Counter

import numpy as np

from armlens.llm import lm_scoring as M


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def held(name):
    return name is not None and zlib.crc32(str(name).encode()) % 7 == 2


def check(rows, got):
    c = Counter()
    for name, text in rows:
        if not held(name):
            c.update(tokens(text))
    n, v = sum(c.values()), len(c)
    want = sorted(((name, held(name), len(tokens(text)), sum(w in c for w in tokens(text)), n,
                    sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(text))) for name, text in rows), key=str)
    got = sorted((tuple(r[f] for f in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"))
                  for r in got), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)


def test_counts_and_base_match_brute_force(make_docs, small_texts, monkeypatch):
    monkeypatch.setattr(M, "COMMON", 50)  # most tokens take the join
    rows = [r[:2] for r in small_texts]
    check(rows, M.score_documents(make_docs(rows)).collect())


def test_model_beats_the_base_on_held_out_rows(make_docs):
    rnd = random.Random(1)
    follow = {f"w{i}": [f"w{rnd.randrange(60)}" for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(500):
        w, text = f"w{rnd.randrange(60)}", []
        for _ in range(rnd.randint(5, 60)):
            text.append(w)
            w = rnd.choice(follow[w])
        rows.append((i, " ".join(text)))
    got = [r for r in M.score_documents(make_docs(rows)).collect() if r["held_out"]]
    assert len(got) > 30
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) + 0.1 * sum(r["n_tokens"] for r in got)


def test_probabilities_sum_to_one(make_docs):
    """Over all tokens that can follow, with one unseen token in each class."""
    w = np.random.default_rng(0).normal(size=((1 << M.BITS) + 1, M.CLASSES)).astype(np.float32)
    f = M._features(np.array([5, 6, 7], np.uint64), np.array([0]), np.array([3]))
    z = M._logits(w, f)
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    counts = {0: [3, 4], 1: [1]}
    inside = sum((c + 1) / (sum(counts[0]) + 2 + 1) for c in counts[0]) + 1 / (sum(counts[0]) + 2 + 1)
    assert math.isclose(inside, 1)


def test_features_do_not_reach_into_other_documents():
    h = np.array([1, 2, 3, 4, 5], np.uint64)
    both = M._features(h, np.array([0, 1]), np.array([1, 4]))
    alone = M._features(h[1:], np.array([0]), np.array([4]))
    assert (both[1:] == alone).all()


def test_edges(make_docs, edge_rows):
    check(edge_rows, M.score_documents(make_docs(edge_rows)).collect())
    assert M.score_documents(make_docs([])).count() == 0
    only = [(i, "x y") for i in range(40) if held(i)]
    got = M.score_documents(make_docs(only)).collect()
    assert all(r["held_out"] and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in got)


def test_gradients_are_summed_as_by_reduceat():
    """Runs of every length are added over whole rows, many runs at a time, and agree to the last bit."""
    rng = np.random.default_rng(5)
    z = rng.standard_normal((4096, 8)).astype(np.float32)
    size = np.sort(np.concatenate([np.arange(1, 300), [1] * 50, [4096, 1025, 257]]))[::-1]
    of = rng.integers(0, len(z), size.sum())
    place = rng.permutation(len(size))
    begin = np.cumsum(size[place]) - size[place]
    first = np.empty(len(size), np.int64)
    first[place] = begin
    want = np.add.reduceat(z[of], begin, axis=0)
    assert np.array_equal(M._summed(z, of, first, size)[place], want)


def test_tokens_of_texts_met_together():
    import pyarrow as pa
    texts = [None, "", "  Ab \x0b\x1cab ", "É é.\nAB", " ", "the ab"]
    lexicon = M._Lexicon({b"ab": 7}, {b"the": 3, b"\n": 0})
    for given in (pa.array(texts), pa.array(["left out", *texts]).slice(1)):
        flat, start, size = M._flat(given, lexicon)
        tokens = [M._tokens(t) for t in texts]
        assert [lexicon.tokens[k] for k in flat] == [t for ts in tokens for t in ts]
        assert size.tolist() == list(map(len, tokens)) and start.tolist() == (np.cumsum(size) - size).tolist()
        hashes, classes, counts = lexicon.arrays()
        assert counts[lexicon[b"ab"]] == 7 and counts[lexicon[b"the"]] == -1
        assert classes[lexicon[b"the"]] == 3 and classes[lexicon[b"\n"]] == 0 and classes[lexicon[b"ab"]] == M._tail_class(b"ab")
        assert len(set(hashes.tolist())) == len(lexicon) == len(lexicon.tokens)
    assert len(M._flat(pa.array([], pa.string()), lexicon)[0]) == 0
