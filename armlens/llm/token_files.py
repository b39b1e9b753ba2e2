"""Token-ID files in patched frame-of-reference blocks (operator 2).

Documents are sorted by doc_id (range partitions, sorted inside), encoded with
the tokenizers library, ended with ``END`` and packed into segments of at most
``SEGMENT_IDS`` ids. A segment is one binary file image:

    header   magic "PFR1", number of ids, number of documents, number of blocks (uint32)
    lengths  ids of each document (uint32)
    index    byte offset of each block (uint64)
    blocks   of BLOCK ids: minimum (uint32), width (uint8), exceptions (uint16),
             the low ``width`` bits of (id - minimum), bit-packed,
             positions (uint16) and high parts (uint32) of the exceptions

The width is the ``PERCENTILE``-th percentile of the bits that a block's values
need; values that need more go to the exception list. A reader of ids
[a, b) seeks the blocks a // BLOCK .. through the index.

Segments are written by Spark as rows of a parquet table (partition number,
segment number, first doc_id, image), so any Hadoop file system serves and a
lost task leaves nothing behind. Starts are sums over partitions, then over
segments, then inside a segment.

Words repeat, so a worker remembers the ids of white-space separated words, from
task to task; every word is encoded by the library, and no token of this vocabulary
spans white space. New words go to the library many in one text, cut again at the
offsets of its tokens. If the tokenizer lower-cases and splits by ``SPLIT``, words
of ASCII characters are new only by the pieces of that split. A document longer
than a segment gets a segment of its own.

Defined cases: NULL and empty texts have the end id only; NULL doc_ids come
first; rows that repeat a doc_id follow each other in the order of their text
hash; an empty table writes no segment and reads back empty.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from armlens.llm.common import small_batches
from armlens.session import ensure_checkpoint_dir

END = 2
BLOCK = 1024
PERCENTILE = 95
SEGMENT_IDS = 1 << 18
PIECES = 500_000  # pieces, and whole words of other characters, that a worker remembers as the library encoded them
TEXT_BYTES = 8_000_000  # texts whose distinct words are looked up together
JOINED = 500     # words in one call of the library
# A split that is known here, and what it is on lower-case plain words, one a line.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+|\n")
# Letters and signs up to U+017E that no normalisation changes, whose lower case is one such character, and on
# which \w, \d and \s of ``re`` agree with \p{L}, \p{N} and \s of the split.
PLAIN = r"^[\x21-\x7e\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-\x{12f}\x{131}-\x{148}\x{14a}-\x{17e}]+\z"
MAGIC = b"PFR1"


def pack_block(ids: np.ndarray) -> bytes:
    """One block of at most BLOCK ids (uint32)."""
    low = int(ids.min())
    value = ids - np.uint32(low)
    need = np.ceil(np.log2(value.astype(np.float64) + 1)).astype(np.int64)  # bits of each value
    width = int(np.sort(need)[min(len(need) - 1, len(need) * PERCENTILE // 100)])
    odd = np.flatnonzero(need > width)
    bits = ((value[:, None] >> np.arange(width, dtype=np.uint32)[None, :]) & np.uint32(1)).astype(np.uint8)
    return (struct.pack("<IBH", low, width, len(odd)) + np.packbits(bits.ravel(), bitorder="little").tobytes()
            + odd.astype("<u2").tobytes() + (value[odd] >> np.uint32(width)).astype("<u4").tobytes())


def write_segment(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file image of one segment."""
    blocks, offsets, at = [], [], 0
    for b in range(0, len(ids), BLOCK):
        image = pack_block(ids[b:b + BLOCK])
        offsets.append(at)
        blocks.append(image)
        at += len(image)
    return b"".join([MAGIC, struct.pack("<III", len(ids), len(lengths), len(blocks)), lengths.astype("<u4").tobytes(),
                     np.array(offsets, "<u8").tobytes(), *blocks])


def _unpack(image: memoryview, at: int, n: int) -> np.ndarray:
    low, width, odd = struct.unpack_from("<IBH", image, at)
    at += 7
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(image, np.uint8, size, at), bitorder="little")[:n * width].reshape(n, width)
    value = (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)[None, :]).sum(axis=1, dtype=np.uint32)
    at += size
    if odd:
        where = np.frombuffer(image, "<u2", odd, at)
        value[where] |= np.frombuffer(image, "<u4", odd, at + 2 * odd) << np.uint32(width)
    return value + np.uint32(low)


def read_segment(image: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids [first, last) of a segment, reading only the blocks that hold them."""
    view = memoryview(image)
    if view[:4] != MAGIC:
        raise ValueError("not a token segment")
    total, docs, blocks = struct.unpack_from("<III", view, 4)
    last = total if last is None else min(last, total)
    if first >= last:
        return np.empty(0, np.uint32)
    index = np.frombuffer(view, "<u8", blocks, 16 + 4 * docs)
    base = 16 + 4 * docs + 8 * blocks
    lo, hi = first // BLOCK, (last - 1) // BLOCK
    got = [_unpack(view, base + int(index[b]), min(BLOCK, total - b * BLOCK)) for b in range(lo, hi + 1)]
    return np.concatenate(got)[first - lo * BLOCK:last - lo * BLOCK]


def segment_lengths(image: bytes) -> np.ndarray:
    docs = struct.unpack_from("<III", image, 4)[1]
    return np.frombuffer(image, "<u4", docs, 16)


def splits_ascii(tokenizer) -> bool:
    """Whether the tokenizer's file says that it lower-cases, then encodes every match of ``SPLIT`` by itself."""
    told = json.loads(tokenizer.to_str())
    steps = lambda part, inner: part.get(inner, [part]) if part else []
    normal = [n["type"] for n in steps(told.get("normalizer"), "normalizers")]
    first = (steps(told.get("pre_tokenizer"), "pretokenizers") or [{}])[0]
    return ("Lowercase" in normal and set(normal) <= {"NFC", "Replace", "Lowercase"}
            and all(n["pattern"] == {"Regex": "\\s+"} and n["content"] == " "
                    for n in steps(told.get("normalizer"), "normalizers") if n["type"] == "Replace")
            and first.get("type") == "Split" and first["pattern"] == {"Regex": SPLIT}
            and first["behavior"] == "Removed" and first["invert"])


def encode_words(tokenizer, words: list[bytes]) -> list[bytes]:
    """The ids (uint32) of each word: the library encodes ``JOINED`` words in one text."""
    out = []
    for at in range(0, len(words), JOINED):
        part = [w.decode("utf-8", "replace") for w in words[at:at + JOINED]]
        got = tokenizer.encode(" ".join(part), add_special_tokens=False)
        size = np.fromiter(map(len, part), np.int64, len(part)) + 1
        begin = np.fromiter((o[0] for o in got.offsets), np.int64, len(got.offsets))
        # inside a word normalisation may turn characters about
        first = np.searchsorted(np.maximum.accumulate(begin), np.cumsum(size) - size)
        ids, cut = np.array(got.ids, np.uint32).tobytes(), (np.append(first, len(begin)) * 4).tolist()
        out.extend(ids[a:z] for a, z in zip(cut, cut[1:]))
    return out


def piece_tokenizer(tokenizer):
    """(the tokenizer for pieces that are lower-case and split already, whether an id ends a piece): the file's model
    on what stands between spaces, after the file's mapping of bytes. None if the file does more to a piece than that,
    or its ids do not tell where a piece ends."""
    from tokenizers import Tokenizer, pre_tokenizers
    told = json.loads(tokenizer.to_str())
    rest = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])[1:]
    suffix = told["model"].get("end_of_word_suffix")
    if not suffix or [(p["type"], p.get("add_prefix_space"), p.get("use_regex")) for p in rest] != [("ByteLevel", False, False)]:
        return None
    own = Tokenizer(tokenizer.model)
    own.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    vocabulary = own.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return own, ends


def encode_pieces(by_piece, pieces: list[str]) -> list[bytes] | None:
    """The ids (uint32) of each piece, by ``piece_tokenizer``; None if the ids do not fall into the pieces."""
    tokenizer, ends = by_piece
    texts = [" ".join(pieces[at:at + JOINED]) for at in range(0, len(pieces), JOINED)]
    held = [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    ids = np.concatenate(held) if held else np.empty(0, np.uint32)
    cut = (np.flatnonzero(ends[ids]) + 1) * 4
    if len(cut) != len(pieces):
        return None
    raw, cut = ids.tobytes(), cut.tolist()
    return [raw[a:z] for a, z in zip([0, *cut], cut)]


def gathered(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``which`` of a list of lists (``flat``, ``size``) one after the other, and where each ends."""
    first = np.cumsum(size) - size
    n = size[which]
    upto = np.cumsum(n)
    return flat[np.repeat(first[which] - (upto - n), n) + np.arange(n.sum())], upto


class _WordIds(dict):
    """Ids of words. ``pieces``: piece -> its ids (uint32 bytes), for pieces of plain words (text) and whole words of
    other characters (bytes); pieces not met before are encoded many in a call."""

    def __init__(self, tokenizer):
        super().__init__()
        tokenizer.no_truncation()
        self.tokenizer, self.pieces = tokenizer, {}
        self.by_piece = piece_tokenizer(tokenizer) if splits_ascii(tokenizer) else None

    def learn(self, texts: list) -> None:
        """Hold the ids (uint32 bytes) of the words (bytes) of ``texts`` by word."""
        words = [w for w in set().union(*texts) if w not in self]
        flat, size = self.of_words(pa.array([w.decode("utf-8", "replace") for w in words], pa.string()))
        cut = np.cumsum(size).tolist()
        self.update((w, flat[a:z].tobytes()) for w, a, z in zip(words, [0, *cut], cut))

    def lists(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after the other, and their numbers."""
        known = self.pieces
        if len(known) > PIECES:
            known.clear()
        new = [p for p in pieces if p not in known]
        plain = [p for p in new if isinstance(p, str)]
        known.update(zip(plain, encode_pieces(self.by_piece, plain) or () if plain else ()))
        rest = [p for p in new if p not in known]
        known.update(zip(rest, encode_words(self.tokenizer, [p.encode() if isinstance(p, str) else p for p in rest])))
        held = list(map(known.__getitem__, pieces))
        return np.frombuffer(b"".join(held), np.uint32), np.fromiter(map(len, held), np.int64, len(held)) // 4

    def of_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all (distinct) words one after the other, and their numbers."""
        is_plain = (pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False) if self.by_piece
                    else np.zeros(len(words), bool))
        plain = words.filter(pa.array(is_plain))
        other = words.filter(pa.array(~is_plain)).cast(pa.binary()).to_pylist()
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(plain)], plain), "\n")[0].as_py()
        found = pa.array(PLAIN_SPLIT.findall(text.lower()), pa.string()).dictionary_encode()
        distinct, which = found.dictionary.to_pylist(), found.indices.to_numpy()
        # the line break between two words has no ids
        breaks = distinct.index("\n") if len(plain) > 1 else -1
        ends = np.append(np.flatnonzero(which == breaks), len(which)) if len(plain) else np.empty(0, np.int64)
        names = [p for p in distinct if p != "\n"] + other
        flat, size = self.lists(names)
        if breaks >= 0:
            size = np.insert(size, breaks, 0)
        total = len(distinct)
        flat, upto = gathered(flat, size, np.concatenate([which, np.arange(total, total + len(other))]))
        stops = np.append(0, upto)
        sizes = np.empty(len(words), np.int64)
        sizes[is_plain] = np.diff(stops[ends], prepend=0)
        sizes[~is_plain] = size[total:]
        # plain words stand first in ``flat``
        order = np.empty(len(words), np.int64)
        order[np.concatenate([np.flatnonzero(is_plain), np.flatnonzero(~is_plain)])] = np.arange(len(words))
        by_place = np.concatenate([sizes[is_plain], sizes[~is_plain]])
        return gathered(flat, by_place, order)[0], sizes

    def encoded(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, the end id after each, and the number of ids of each text."""
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        found = lists.flatten().dictionary_encode()  # a word may be empty, beside leading or trailing spaces
        flat, size = self.of_words(found.dictionary)
        flat, size = np.append(flat, np.uint32(END)), np.append(size, 1)
        stops = lists.offsets.to_numpy().astype(np.int64)
        stops -= stops[0]
        ids, upto = gathered(flat, size, np.insert(found.indices.to_numpy(), stops[1:], len(size) - 1))
        return ids, np.diff(upto[stops[1:] + np.arange(len(texts))], prepend=0)


@lru_cache(maxsize=1)
def _word_ids(path: str) -> _WordIds:
    """Kept by the worker for later tasks."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # a special token's string in a text is ordinary text
    return _WordIds(tokenizer)


def _together(batches):
    """The rows of ``batches`` in the same order, about ``TEXT_BYTES`` at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= TEXT_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _segments(path: str, segment_ids: int):
    def run(batches):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from pyspark import TaskContext
        known, part = _word_ids(path), TaskContext.get().partitionId()
        number, names, sizes, parts, held = 0, [], [], [], 0

        def row():
            return pa.RecordBatch.from_pydict(
                {"part": [part], "segment": [number], "n_ids": [held], "names": pa.array([names], pa.list_(pa.int64())),
                 "image": [write_segment(np.concatenate(parts), np.array(sizes))]})

        for some in _together(batches):
            ids, lengths = known.encoded(some.column(1))
            stop = 0
            for name, n in zip(some.column(0).to_pylist(), lengths.tolist()):
                if names and held + n > segment_ids:
                    yield row()
                    number, names, sizes, parts, held = number + 1, [], [], [], 0
                names.append(name), sizes.append(n), parts.append(ids[stop:stop + n])
                held += n
                stop += n
        if names:
            yield row()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 segment_ids: int = SEGMENT_IDS) -> None:
    """Write the segments of ``docs`` in ascending doc_id order under ``path``."""
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      F.xxhash64(text_col).alias("tie"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = own.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    (ordered.select("doc_id", "text")
     .mapInArrow(_segments(tokenizer_path, segment_ids), "part long, segment long, n_ids long, names array<long>, image binary")
     .write.parquet(path))


def read_tokens(spark, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")  # segments, not texts
    files = spark.read.schema("part long, segment long, n_ids long, names array<long>, image binary").parquet(path)
    heads = files.select("part", "segment", "n_ids")
    # sums inside a partition's segments, then over the partitions (few rows each)
    inside = W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = heads.groupBy("part").agg(F.sum("n_ids").alias("t"))
    bases = totals.select("part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    starts = heads.withColumn("in_part", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(bases, "part").select(
        "part", "segment", (F.col("in_part") + F.col("base")).alias("first"))

    def documents(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                image = batch.column("image")[r].as_py()
                names = batch.column("names")[r].values
                lengths = segment_lengths(image).astype(np.int64)
                ids = read_segment(image)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n:e].astype("<u4").tobytes()) for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("part")[r].as_py()] * len(names), pa.int64()),
                     pa.array([batch.column("segment")[r].as_py()] * len(names), pa.int64()),
                     names, pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = files.select("part", "segment", "names", "image").mapInArrow(
        documents, "part long, segment long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files into the shared checkpoint folder and read them back."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, tokenizer_path, path, id_col, text_col)
    return read_tokens(spark, path)
