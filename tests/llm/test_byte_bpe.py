import hashlib
import random

import numpy as np
import public_tokenizers as tokenizers
import tiktoken
from pyspark.sql import functions as F

from armlens.llm import byte_bpe as E

RANKS = tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library():
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=E.read_ranks(RANKS), special_tokens={})


def check(rows, df):
    enc = library()
    want = sorted(((n, enc.encode_ordinary(t or ""), t or "") for n, t in rows), key=str)
    got = sorted(((r["doc_id"], list(r["ids"]), r) for r in df.collect()), key=lambda x: str(x[:2]))
    want = sorted(want, key=lambda x: str(x[:2]))
    assert len(got) == len(want)
    for (n, ids, r), (m, expected, text) in zip(got, want):
        assert n == m and ids == expected and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_matches_the_library(make_docs, small_texts):
    rows = [r[:2] for r in small_texts]
    check(rows, E.encode_documents(make_docs(rows), RANKS, tokenizers.PATTERN, with_ids=True))


def test_small_chunks_give_the_same(make_docs, small_texts):
    rows = [r[:2] for r in small_texts[:40]]
    check(rows, E.encode_documents(make_docs(rows), RANKS, tokenizers.PATTERN, with_ids=True, chunk_chars=2000))


def test_odd_characters(make_docs):
    rnd = random.Random(5)
    odd = [chr(c) for c in (9, 10, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x2028, 0x3000, 0x200B, 0xFEFF, 0xE9, 0x4E2D,
                            0x1F600, 0x0301, 0x0660, 0x2167, 0x5F, 0x27)] + list("abz09'!?.$")
    rows = [(i, "".join(rnd.choices(odd, k=rnd.randint(1, 60)))) for i in range(300)]
    rows += [(1000, "it's we'll I'd 'S"), (1001, "a" * 700 + "é" * 300 + "=" * 500), (1002, "   \n\n  x  ")]
    check(rows, E.encode_documents(make_docs(rows), RANKS, tokenizers.PATTERN, with_ids=True))


def test_edges(make_docs, edge_rows):
    check(edge_rows, E.encode_documents(make_docs(edge_rows), RANKS, tokenizers.PATTERN, with_ids=True))
    assert E.encode_documents(make_docs([]), RANKS, tokenizers.PATTERN).count() == 0


def test_long_pieces_are_merged_in_n_log_n(make_docs):
    rnd = random.Random(2)
    rows = [(1, "a" * 20_000), (2, "".join(rnd.choices("abcde", k=60_000))), (3, "=" * 30_001 + " x"), (4, "é漢😀" * 4_000),
            (5, " " * 25_000), (6, "1" * 199 + " " + "b" * 200 + " " + "c" * 201)]
    check(rows, E.encode_documents(make_docs(rows), RANKS, tokenizers.PATTERN, with_ids=True))
    ranks = E.read_ranks(RANKS)
    enc = library()
    for k in range(1, 60):
        piece = "".join(rnd.choices("abtheé ", k=k)).strip() or "x"
        assert E.merged_by_heap(piece.encode(), ranks) == enc._encode_single_piece(piece.encode())


def test_packed_symbols():
    for symbols in ([], [0], [5, 7, 2 ** 30, 5], list(range(0, 50_000, 7)) * 2, [3] * 1000):
        assert E._unpacked(E._packed(np.array(symbols, np.int64))).tolist() == symbols


def test_ids_in_words(spark):
    rows = [(k, [(k * 7919 + j * 104_729) % (1 << 17 - 1) for j in range(n)]) for k, n in enumerate((0, 1, 2, 3, 4, 6, 7, 20, 5))]
    df = spark.createDataFrame(rows, "number int, ids array<int>").select("number", *E._in_words(F.col("ids")))
    flat, first, size = E._from_words(df.orderBy("a").toArrow())
    assert [flat[a:a + n].tolist() for a, n in zip(first, size)] == [r[1] for r in rows]
    assert len(E._from_words(df.limit(0).toArrow())[0]) == 0


def test_plain_texts_are_cut_as_the_pattern_cuts():
    import regex
    fast, full = E.piece_cutter(tokenizers.PATTERN), regex.compile(tokenizers.PATTERN).findall
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f" {c}1 {c}", f"'{c}s{c}{c}", f"{c} {c}\n{c}_{c}"):
            assert fast(text) == full(text), (hex(ord(c)), text)
    rnd = random.Random(9)
    for _ in range(3000):
        text = "".join(rnd.choices("ab é1²_'sßl \n\t.,ªº\xa0\x1cµ中", k=30))
        assert fast(text) == full(text)


def test_chunks_stay_where_they_are(spark, make_docs, small_texts):
    df = E.encode_documents(make_docs([r[:2] for r in small_texts[:50]]), RANKS, tokenizers.PATTERN)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3  # two branches of pieces, and their ids


def test_numbers_in_spare_bits(spark):
    rows = [(n, [(1 << 17) - 2] * k) for k, n in enumerate((0, 1, 8191, 8192, (1 << 26) - 1, 1 << 26, (1 << 31) - 1))]
    df = spark.createDataFrame(rows, "number int, ids array<int>").select("number", *E._in_words(F.col("ids")))
    packed = df.select(*E._numbered(F.col("number"))).toArrow()
    plain = E._unnumbered(packed)
    for c in ("number", "a", "b", "rest"):
        assert plain.column(c).to_pylist() == df.toArrow().column(c).to_pylist()


def test_bytes_and_a_step_are_read_once(spark):
    ids = F.array(*[F.lit(1000 + b) for b in range(256)])
    texts = ["", "a", "é漢😀\x00\x7f\x80ÿ", "".join(map(chr, range(1, 600)))]
    got = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", E._bytes(F.col("t"), ids).alias("b")).collect()
    assert {r["n"]: r["b"] for r in got} == {n: [1000 + b for b in t.encode()] for n, t in enumerate(texts)}
    column = E.merged_ids(F.col("t"), ids, [ids, ids], [255, 253])._jc.toString()
    assert column.count("array_min") == 1 and "conv" not in column
