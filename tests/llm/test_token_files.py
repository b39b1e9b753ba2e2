import uuid
import zlib

import numpy as np
import public_tokenizers as tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from armlens.llm import token_files as T

PATH = tokenizers.path("word_bpe_49k.json")


def brute(rows):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    out, start = [], 0
    for name, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [T.END]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in df.collect()), key=lambda r: r[1])


def test_files_read_back(make_docs, small_texts):
    rows = [r[:2] for r in small_texts]
    assert result(T.token_files(make_docs(rows), PATH)) == brute(rows)


def test_small_segments(spark, make_docs, small_texts, tmp_path):
    rows = [r[:2] for r in small_texts[:60]]
    path = str(tmp_path / uuid.uuid4().hex)
    T.write_tokens(make_docs(rows), PATH, path, segment_ids=700)
    assert spark.read.parquet(path).count() > 20
    assert result(T.read_tokens(spark, path)) == brute(rows)


def test_edges(make_docs, edge_rows):
    rows = edge_rows + [(20, "Straße ÉTÉ <|endoftext|> don't\tİstanbul é"), (21, "a\x1cb !\x1c!  x y")]
    assert result(T.token_files(make_docs(rows), PATH)) == brute(rows)
    assert T.token_files(make_docs([]), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), min_size=1, max_size=3000), st.data())
def test_block_round_trip(values, data):
    ids = np.array(values, np.uint32)
    image = T.write_segment(ids, np.array([len(ids)]))
    assert (T.read_segment(image) == ids).all()
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert (T.read_segment(image, a, b) == ids[a:b]).all()
    assert T.segment_lengths(image).tolist() == [len(ids)]


def test_outliers_do_not_widen_the_block():
    ids = np.arange(1024, dtype=np.uint32) % 8
    plain = len(T.pack_block(ids))
    ids[::100] = 2**31
    assert len(T.pack_block(ids)) < plain + 11 * 6 + 1


def test_new_words_in_one_text_and_by_pieces_as_alone():
    """Words that meet in one call of the library, and ASCII words by their pieces, have the ids they have alone."""
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    odd = ["it's", "IT'S", "'sx", "x''s", "!'s", "we'll've", "a1b22", "a_b", "__", "don't!", "<|endoftext|>", "\x00\x1b", "a\x1cb", "\x1d",
           " ", "ẹ́x", "́a", "가", "각", "ΑΣ", "İx", "K", "ﬁ", "Ⅷ", "x y", "🙂🏽", "﻿",
           "'", "''", "-'d", "Hello,World", "3.14", "\x7f", "É", "é", *[chr(c) for c in range(33, 127)], *[f"{chr(a)}'{chr(b)}" for a in range(33, 127) for b in (83, 115, 33, 49)]]
    words = [w.encode() for w in odd] + [b"\xff\xfe", b"a\xc3"]
    want = [np.array(tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32).tobytes() for w in words]
    assert T.splits_ascii(tokenizer)
    assert T.encode_words(tokenizer, words) == want
    known = T._WordIds(tokenizer)
    known.learn([words, []])
    assert [known[w] for w in words] == want
    calls = len(known.pieces)
    known.learn([[b"hello", b"world", b"HELLO"]])  # their pieces are known
    assert len(known.pieces) == calls and known[b"HELLO"] == known[b"hello"]


def test_plain_words_by_their_pieces():
    """Words cut and lower-cased here, of every character below U+0250, have the library's ids, in texts that meet together."""
    import pyarrow as pa
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    chars = [chr(c) for c in range(1, 0x250)]
    texts = [None, "", " ", *[f" {c} x{c}y {c}{c} a'{c}s 1{c}_ {c}\u0301 É{c}\n" for c in chars], "one", None]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [T.END] for t in texts]
    known = T._WordIds(tokenizer)
    assert known.by_piece
    for given in (pa.array(texts, pa.string()), pa.array(["skipped", *texts], pa.string()).slice(1)):
        ids, lengths = known.encoded(given)
        assert lengths.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    # é, É, and plain signs take the model's short way, other characters the whole tokenizer
    assert {p for p in ("é", "éé") if p in known.pieces} and any(isinstance(p, bytes) for p in known.pieces)
    nothing = known.encoded(pa.array([], pa.string()))
    assert len(nothing[0]) == len(nothing[1]) == 0


def test_another_tokenizer_goes_whole():
    """A tokenizer whose file says anything else than a known split is used whole on every word."""
    from tokenizers import models, pre_tokenizers
    import pyarrow as pa
    own = Tokenizer(models.WordLevel({"a": 0, "B": 1, "?": 3}, unk_token="?"))
    own.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    known = T._WordIds(own)
    assert known.by_piece is None
    assert known.encoded(pa.array(["a B", "b  a"]))[0].tolist() == [0, 1, T.END, 3, 0, T.END]
