import hashlib

import public_tokenizers as tokenizers
import tiktoken

import corpus_pipeline as P
from armlens.llm import byte_bpe, mixing
from armlens.llm.common import read_table
from test_near_dup import brute as near_brute

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dup", "mixing", "byte_bpe"]


def test_each_stage_on_its_own_input(spark):
    docs = read_table(spark, SF, "documents")
    start = docs.collect()
    clean = spark.createDataFrame(P.drop_toxic(spark, docs, SF).collect(), docs.schema)
    rows = clean.collect()
    labels = {r["doc_id"]: r["toxic"] for r in read_table(spark, SF, "labels").collect()}
    assert clean.columns == docs.columns
    assert sum(labels.get(r["doc_id"]) == 0 for r in rows) >= 0.95 * sum(labels.get(r["doc_id"]) == 0 for r in start)

    lined = spark.createDataFrame(P.dedup_lines(spark, clean, SF).collect(), docs.schema)
    assert lined.columns == docs.columns and lined.count() == len(rows)
    before = {r["doc_id"]: r["text"] for r in rows}
    for r in lined.collect():
        assert r["n_chars"] == len(r["text"]) and len(r["text"]) <= len(before[r["doc_id"]])

    single = spark.createDataFrame(P.drop_near_duplicates(spark, lined, SF).collect(), docs.schema)
    want = {n for n, _, _, kept in near_brute([(r["doc_id"], r["text"]) for r in lined.collect()], 5, 80) if kept}
    assert {r["doc_id"] for r in single.collect()} == want and single.count() == len(want)

    mixed = spark.createDataFrame(P.mix_sources(spark, single, SF).collect(), docs.schema)
    drawn = {r["id"]: len(r["draws"]) for r in mixing.mix(single).collect()}
    count = {}
    for r in mixed.collect():
        count[r["doc_id"]] = count.get(r["doc_id"], 0) + 1
    assert count == {i: n for i, n in drawn.items() if n}

    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.read_ranks(tokenizers.path(P.RANKS)))
    text = {r["doc_id"]: r["text"] for r in mixed.collect()}
    out = P.encode(spark, mixed, SF).collect()
    assert len(out) == mixed.count()
    for r in out:
        assert list(r["ids"]) == enc.encode_ordinary(text[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_run_gives_the_last_stage(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and out.count() > 100


def test_stages_on_edges_and_nothing(spark, make_docs, edge_rows):
    """NULLs, empty and long texts, repeated rows, clashing extra columns, and no rows at all."""
    for rows in (edge_rows, []):
        docs = make_docs(rows)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            got = out.collect()
            if name == "byte_bpe":
                assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(r[0]) for r in rows)
                continue
            assert out.columns == docs.columns, name
            kept = {(r["doc_id"], r["text"]) for r in got}
            assert kept <= {(r[0], r[1]) for r in rows}, name
            if name in ("toxicity", "line_dedup"):
                assert len(got) == len(rows), name
            if name == "near_dup":  # the repeated row goes, everything else stays
                assert sorted(map(str, kept)) == sorted(map(str, {(r[0], r[1]) for r in rows})) and len(got) == len(kept)
