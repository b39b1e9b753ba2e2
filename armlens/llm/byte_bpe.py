"""Byte-level BPE encoding and decoding (operator 8).

1. Texts are cut into pieces by the tokenizer's pattern, each match separately
   (Arrow stage). A chunk of documents (at most ``CHUNK_CHARS`` characters, or
   one longer document) becomes one row of numbers, a token id for every piece
   that is a token, else a reference to one of the chunk's distinct other pieces,
   which are rows of their own. The chunks are written in buckets, so they need
   not move when their pieces come back.
2. Spark higher-order functions fold the ranked merges over the bytes of every
   distinct piece of the corpus, once, with the rank map as a literal.
3. The encoded pieces go back to their chunks (``cogroup``: a chunk is bounded by
   its characters), where the ids of every text are put together and decoded by
   concatenating the binary pieces of the ids.

A fold of n bytes copies arrays n times, so a piece of more than ``LONG_PIECE``
bytes, which is no word, is merged over a heap of its pairs: the same merges in
the same order, in n log n.

Defined cases: a NULL or empty text has no ids and decodes to no bytes; ids of
NULL or repeated doc_ids are encoded like any other row; very long texts and
pieces are encoded whole; an empty table gives an empty result; columns other
than the id and text are never read.
"""
from __future__ import annotations

import base64
import hashlib
import heapq
import re
import uuid

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import releasing, small_batches
from armlens.session import ensure_checkpoint_dir

NO_RANK = 2 ** 31 - 1
ID_BITS = 17
ID_MASK = (1 << ID_BITS) - 1
SPARE = 13                  # bits of a word beside three ids
LONG_PIECE = 200            # bytes
CHUNK_CHARS = 16_000_000
_ROW_PIECES = 1000
_BLOCK = 500_000
_CHUNK_ROW = "chunk long, number int, pieces array<string>, names array<long>, sizes array<int>, symbols binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a ``.tiktoken`` file (base64 token and rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def pair_ranks(ranks: dict[bytes, int]):
    """(id, id, id of the joined bytes) for every way to cut a token into two tokens."""
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                yield left, right, rank


def rank_literal(ranks: dict[bytes, int]) -> tuple[list[Column], list[int]]:
    """The rank map as two literals (arrays after constant folding) and their sizes: an entry holds
    ``pair << ID_BITS | rank`` and stands in the first array at pair mod its size or so in the second."""
    entries = np.fromiter(((left << ID_BITS | right) << ID_BITS | rank for left, right, rank in pair_ranks(ranks)), np.int64)
    sizes = [int(1.2 * len(entries)) | 1, int(1.4 * len(entries)) | 1]
    slots = [np.full(n, -1, np.int64) for n in sizes]
    for entry in entries.tolist():
        side = 0
        for _ in range(500):  # cuckoo hashing: an entry that is pushed out moves to its other place
            at = (entry >> ID_BITS) % sizes[side]
            entry, slots[side][at] = int(slots[side][at]), entry
            if entry < 0:
                break
            side = 1 - side
        else:
            raise ValueError("too many merges for the table")
    blocks = [",".join(map(str, t[k:k + 10_000].tolist())) for t in slots for k in range(0, len(t), 10_000)]
    cut = -(-sizes[0] // 10_000)
    return [F.split(F.lit(",".join(part)), ",").cast("array<bigint>") for part in (blocks[:cut], blocks[cut:])], sizes


def merged_by_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a long piece: the lowest rank first, of equal ranks the leftmost."""
    parts = [piece[k:k + 1] for k in range(len(piece))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(r, k) for k in range(len(parts) - 1) if (r := ranks.get(parts[k] + parts[k + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, k = heapq.heappop(heap)
        nxt = after[k]
        if parts[k] is None or nxt >= len(parts) or ranks.get(parts[k] + parts[nxt]) != rank:
            continue  # one of the two has been merged since
        parts[k], parts[nxt] = parts[k] + parts[nxt], None
        after[k] = after[nxt]
        if after[k] < len(parts):
            before[after[k]] = k
            if (r := ranks.get(parts[k] + parts[after[k]])) is not None:
                heapq.heappush(heap, (r, k))
        if before[k] >= 0 and (r := ranks.get(parts[before[k]] + parts[k])) is not None:
            heapq.heappush(heap, (r, before[k]))
    return [ranks[p] for p in parts if p is not None]


def merged_ids(piece: Column, byte_ids: Column, tables: list[Column], sizes: list[int]) -> Column:
    """Token ids of one piece: ranked merges folded over the ids of its bytes.

    State: the ids, and for each the rank of joining it to the next. A step
    joins the leftmost pair of the lowest rank and looks up its two new
    neighbours; without a joinable pair the state stays."""
    def rank(left, right):
        pair = F.shiftleft(left.cast("bigint"), ID_BITS).bitwiseOR(right.cast("bigint"))
        found = [F.get(t, (pair % n).cast("int")) for t, n in zip(tables, sizes)]
        return F.when(F.shiftright(found[0], ID_BITS) == pair, found[0].bitwiseAND(ID_MASK).cast("int")).when(
            F.shiftright(found[1], ID_BITS) == pair, found[1].bitwiseAND(ID_MASK).cast("int")).otherwise(NO_RANK)

    def step(s, _):
        def join(p):  # p: place of the pair, from 1; its rank is the id of the joined bytes
            low = F.get(s["ranks"], p - 1)  # read by place: the minimum would be taken at every mention
            left = F.when(p > 1, F.array(rank(F.get(s["ids"], p - 2), low))).otherwise(F.array().cast("array<int>"))
            after = F.get(s["ids"], p + 1)
            right = F.when(after.isNull(), F.lit(NO_RANK)).otherwise(rank(low, after))
            size = F.size(s["ids"])
            return F.when(low == NO_RANK, s).otherwise(F.struct(
                F.concat(F.slice(s["ids"], F.lit(1), p - 1), F.array(low), F.slice(s["ids"], p + 2, size)).alias("ids"),
                F.concat(F.slice(s["ranks"], F.lit(1), F.greatest(p - 2, F.lit(0))), left, F.array(right),
                         F.slice(s["ranks"], p + 2, size)).alias("ranks")))

        at = F.array_position(s["ranks"], F.array_min(s["ranks"])).cast("int")
        return F.transform(F.array(at), join)[0]

    def fold(ids):
        n = F.size(ids)
        joins = F.transform(ids, lambda x, i: F.when(i + 1 < n, rank(x, F.get(ids, i + 1))).otherwise(NO_RANK))
        steps = F.when(n > 1, F.sequence(F.lit(2), n)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, F.struct(ids.alias("ids"), joins.alias("ranks")), step)["ids"]

    return F.transform(F.array(_bytes(piece, byte_ids)), fold)[0]


def _bytes(piece: Column, byte_ids: Column) -> Column:
    """Ids of the bytes of a piece (ids of the 256 single-byte tokens in ``byte_ids``)."""
    raw = F.encode(piece, "UTF-8")
    # read as ISO-8859-1 every byte is one character, whose code is the byte
    every = F.transform(F.split(F.decode(raw, "ISO-8859-1"), ""), lambda c: F.get(byte_ids, F.ascii(c)))
    return F.when(F.octet_length(raw) > 0, every).otherwise(F.array().cast("array<int>"))


def _planes(values: np.ndarray) -> bytes:
    """Compressed byte planes of 32-bit numbers: the high bytes are nearly all alike."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _numbers(held: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(held), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _packed(symbols: np.ndarray) -> bytes:
    """Symbols (numbers from 0) as their ranks by frequency, after the symbols in that order."""
    count = np.bincount(symbols) if len(symbols) else np.empty(0, np.int64)
    order = np.argsort(-count, kind="stable")[:np.count_nonzero(count)]
    rank = np.empty(len(count), np.int32)
    rank[order] = np.arange(len(order))
    table = _planes(np.diff(order, prepend=0))
    return len(table).to_bytes(4, "little") + table + _planes(rank[symbols])


def _unpacked(held: bytes) -> np.ndarray:
    cut = 4 + int.from_bytes(held[:4], "little")
    return np.cumsum(_numbers(held[4:cut]))[_numbers(held[cut:])]


class _Numbers(dict):
    """Piece -> token id, or -1 - place in ``new`` for a piece that is no token."""

    def __init__(self, direct: dict):
        super().__init__(direct)
        self.new = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = -1 - len(self.new)
        self.new.append(piece)
        return number


# Characters below U+0250 on which \w, \d and \s of ``re`` agree with \p{L}, \p{N} and \s of the pattern.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*").fullmatch


def piece_cutter(pattern: str):
    """``findall`` of the pattern. The usual pattern over plain letters is cut by ``re``, which is faster."""
    full = regex.compile(pattern).findall
    if r"\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+" not in pattern:
        return full
    plain = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")).findall
    return lambda text: plain(text) if _PLAIN(text) else full(text)


def _cut(pattern: str, chunk_chars: int, shipped):
    """Rows of ``_CHUNK_ROW``: one for a chunk (names, symbols a document, all symbols: a token id, or the
    number of tokens plus a piece's number), and its distinct pieces that are no token, in order, numbered
    from ``number``."""
    cut = piece_cutter(pattern)

    def run(batches):
        direct = {}
        for rank, token in enumerate(shipped.value):
            try:
                if token:
                    direct[token.decode()] = rank
            except UnicodeDecodeError:
                pass  # no piece of text is an incomplete character
        chunk = TaskContext.get().partitionId() << 32
        names, sizes, numbers, known, held = [], [], [], _Numbers(direct), 0

        def rows():
            order = sorted(range(len(known.new)), key=known.new.__getitem__)  # neighbours share their beginning
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            symbols = np.array(numbers, np.int64)
            refers = symbols < 0
            symbols[refers] = len(shipped.value) + place[-1 - symbols[refers]]
            columns = ["chunk", "number", "pieces", "names", "sizes", "symbols"]
            for a in range(0, len(order), 100 * _ROW_PIECES):
                firsts = list(range(a, min(a + 100 * _ROW_PIECES, len(order)), _ROW_PIECES))
                k = len(firsts)
                lists = [[known.new[i] for i in order[f:f + _ROW_PIECES]] for f in firsts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * k, pa.int64()), pa.array(firsts, pa.int32()), pa.array(lists, pa.list_(pa.string())),
                     pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.int32())), pa.nulls(k, pa.binary())], columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.list_(pa.string())),
                 pa.array([names], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([_packed(symbols)], pa.binary())], columns)

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size = len(text) if text else 0
                if names and held + size > chunk_chars:
                    yield from rows()
                    chunk, names, sizes, numbers, known, held = chunk + 1, [], [], [], _Numbers(direct), 0
                start = len(numbers)
                if text:
                    numbers.extend(map(known.__getitem__, cut(text)))
                names.append(name)
                sizes.append(len(numbers) - start)
                held += size
        if names:
            yield from rows()

    return run


def _in_words(ids: Column) -> list[Column]:
    """Ids as two words of three 17-bit numbers each (id + 1, 0: none) and an array of the rest."""
    def word(k):
        part = lambda i: F.shiftleft(F.coalesce(F.get(ids, F.lit(k + i)) + 1, F.lit(0)).cast("long"), i * ID_BITS)
        return part(0).bitwiseOR(part(1)).bitwiseOR(part(2))
    rest = F.when(F.size(ids) > 6, F.slice(ids, F.lit(7), F.size(ids)))
    return [word(0).alias("a"), word(3).alias("b"), rest.alias("rest")]


def _numbered(number: Column) -> list[Column]:
    """The words with ``number`` in their spare low bits, the rest, and what is left of the number, nearly always 0:
    shuffled rows shrink."""
    bits = lambda k: F.shiftright(number, k).bitwiseAND((1 << SPARE) - 1).cast("long")
    return [F.shiftleft("a", SPARE).bitwiseOR(bits(0)).alias("a"), F.shiftleft("b", SPARE).bitwiseOR(bits(SPARE)).alias("b"),
            F.col("rest"), F.shiftright(number, 2 * SPARE).alias("more")]


def _unnumbered(pieces: pa.Table) -> pa.Table:
    a, b, more = (pieces.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "more"))
    low = (1 << SPARE) - 1
    number = more << 2 * SPARE | (b & low) << SPARE | a & low
    ids = ((1 << 3 * ID_BITS) - 1)
    return pa.table({"number": number, "a": a >> SPARE & ids, "b": b >> SPARE & ids, "rest": pieces.column("rest")})


def _from_words(pieces: pa.Table):
    """(ids of all pieces one after the other, first place and number of ids by piece number)."""
    k = pieces.num_rows
    number = pieces.column("number").to_numpy()
    words = [pieces.column(c).to_numpy() for c in ("a", "b")]
    held = np.stack([(w >> (ID_BITS * i)) & ID_MASK for w in words for i in range(3)], axis=1).astype(np.int32) - 1
    rest = pieces.column("rest").combine_chunks().fill_null([]) if k else None
    more = rest.value_lengths().to_numpy().astype(np.int64) if k else np.empty(0, np.int64)
    few = (held >= 0).sum(axis=1) if k else np.empty(0, np.int64)
    start = np.cumsum(few + more) - few - more
    flat = np.empty(int((few + more).sum()), np.int32)
    for at, n, values in ((start, few, held[held >= 0]), (start + few, more, rest.flatten().to_numpy() if k else held[:0, 0])):
        flat[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] = values
    first, size = np.zeros(k, np.int64), np.zeros(k, np.int64)
    first[number], size[number] = start, few + more
    return flat, first, size


def _assembled(shipped, with_ids: bool):
    """Per document of a chunk: n_tokens, digests of the ids and of the decoded bytes (and the ids)."""
    def ids_of(symbols, tokens, flat, first, size):
        refers = symbols >= tokens
        which = symbols[refers] - tokens
        n = np.ones(len(symbols), np.int64)
        n[refers] = size[which]
        ends = np.cumsum(n)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        ids[(ends - n)[~refers]] = symbols[~refers]
        m = n[refers]
        inside = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        ids[np.repeat((ends - n)[refers], m) + inside] = flat[np.repeat(first[which], m) + inside]
        return ids, ends

    def run(chunk: pa.Table, pieces: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(releasing(rows)((chunk, pieces))))

    def rows(tables):
        chunk, pieces = tables
        tokens = shipped.value
        written = [b"%d," % i for i in range(len(tokens))]
        encoded = _from_words(_unnumbered(pieces))
        for names, sizes, held in zip(*(chunk.column(c).to_pylist() for c in ("names", "sizes", "symbols"))):
            symbols, upto = _unpacked(held), np.cumsum([0, *sizes])
            d = 0
            while d < len(names):  # documents of about _BLOCK symbols at a time
                e = max(d + 1, int(np.searchsorted(upto, upto[d] + _BLOCK, "right")) - 1)
                ids, ends = ids_of(symbols[upto[d]:upto[e]], len(tokens), *encoded)
                ends = np.concatenate(([0], ends))[upto[d:e + 1] - upto[d]]
                listed = ids.tolist()
                texts, decoded = [], []
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    some = listed[a:b]
                    texts.append(hashlib.sha256(b"".join(map(written.__getitem__, some))[:-1]).hexdigest())
                    decoded.append(hashlib.sha256(b"".join(map(tokens.__getitem__, some))).hexdigest())
                columns = [pa.array(names[d:e], pa.int64()), pa.array(np.diff(ends)), pa.array(texts), pa.array(decoded)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)))
                yield from pa.Table.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(columns)]
                                                ).to_batches(2000)
                d = e

    return run


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256 and, ``with_ids``, the ids."""
    spark = docs.sparkSession
    small_batches(spark)
    ranks = read_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    byte_ids = F.array(*[F.lit(ranks[bytes([b])]) for b in range(256)])
    tables, places = rank_literal(ranks)
    shipped = spark.sparkContext.broadcast(tokens)  # the vocabulary file: a fixed size
    chunks = _bucketed(own.mapInArrow(releasing(_cut(pattern, chunk_chars, shipped)), _CHUNK_ROW))
    # every distinct piece is folded once; as many partitions as a shuffle has, since little data is much work
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the number in the high half of a word, next to the piece's bytes: shuffled rows compress better
    pieces = chunks.filter("pieces is not null").select("chunk", "number", F.posexplode("pieces").alias("k", "piece")).select(
        "chunk", "piece", F.shiftleft((F.col("number") + F.col("k")).cast("long"), 32).alias("number"))
    # a piece occurs once a chunk; a group holds the chunks of at most 4,096 input partitions
    part = F.shiftright("chunk", 44)
    grouped = (pieces.repartition(parts, F.col("piece"), part).groupBy("piece", part.alias("part"))
               .agg(F.collect_list(F.struct(F.col("chunk").alias("of"), F.shiftright("number", 32).cast("int").alias("number"))).alias("at")))
    folded = F.transform(F.array(F.struct(byte_ids.alias("b"), tables[0].alias("t"), tables[1].alias("u"))),
                         lambda c: merged_ids(F.col("piece"), c["b"], [c["t"], c["u"]], places))[0]
    small = F.octet_length("piece") <= LONG_PIECE
    back = grouped.filter(small).select("at", folded.alias("ids")).unionByName(
        grouped.filter(~small).select("at", "piece").mapInArrow(releasing(_long(shipped)), "at array<struct<of:long,number:int>>, ids array<int>"))
    back = back.select("at", *_in_words(F.col("ids"))).select(F.explode("at").alias("p"), "a", "b", "rest").select(
        "p.of", *_numbered(F.col("p.number")))
    texts = chunks.filter("symbols is not null").select("chunk", "names", "sizes", "symbols")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return texts.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(_assembled(shipped, with_ids), schema)


def _long(shipped):
    """Ids of the pieces of more than ``LONG_PIECE`` bytes."""
    def run(batches):
        ranks = {t: i for i, t in enumerate(shipped.value) if t}
        for batch in batches:
            ids = [merged_by_heap(p.encode(), ranks) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["at", "ids"])

    return run


def _bucketed(chunks: DataFrame) -> DataFrame:
    """The chunks as a table in the shared checkpoint folder, in buckets of ``chunk``: what joins them by chunk
    comes to them. The catalog name is only needed to write buckets; the files stay."""
    spark = chunks.sparkSession
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(parts, "chunk").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # external: the name goes, the files stay
    return table
