"""MinHash near-duplicates by a signature-coordinate inverted join (operator 4).

A document's set holds its distinct ``width``-word shingles (lower-cased A-Z;
with fewer words the whole sequence is the one shingle; without words the set
is empty and linked with nothing). Two documents link when
``100 * |A & B| >= percent * |A | B|``; results are the components of the links.

1. Equal sets collapse into one class, named by its smallest doc_id.
2. Every class posts itself under ``(coordinate, minhash value)`` for the first
   ``k - t + 1`` of ``k`` coordinates (prefix rule): two classes that agree on
   at least ``t`` coordinates must share one of those posting lists.
3. A list is a run of sorted rows. Short lists emit the pairs that agree on
   ``t`` coordinates. Long lists first emit only likely pairs with a few leading
   members (a seeded choice, another in every list), so a group of n near copies
   costs some n pairs, not n * n. Lists of more than ``PART`` members are dealt
   into parts with leaders of their own, other parts at every coordinate.
4. Candidates are confirmed on full shingle sets; confirmed links give
   components; the long lists, cut by set size, then emit only pairs whose
   members are still in different components (skip rule), whose ``FINE`` further
   coordinates agree often enough, and which share no earlier list. A list
   within one component is dropped before its rows are shuffled; of any other
   the rows outside its largest component meet all rows, in blocks of about
   ``BLOCK`` by ``BLOCK`` members and ``SHINGLES`` shingles a side that tasks
   share, so no task holds a list. A block first names the rows that are in such
   a pair; those rows meet again with their shingle sets, are confirmed inside
   the block, and only the links that join components leave it: rows stay in
   proportion to members however many pairs a group has.

With k = 40 and t = 20 a pair at similarity 0.8 is missed with probability
about 5e-6, less above; the further coordinates allow 4.5 standard deviations (3e-6).
Shingles are compared by 64-bit hashes.

Defined cases: NULL, empty and blank texts have the empty set; rows that repeat
a doc_id are each judged by their own text; rows without a doc_id are linked
with nothing, have a NULL component_id and are kept; an empty table gives an
empty result. Columns other than the id and text are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import releasing, small_batches, staged

K, T = 40, 20
PREFIX = K - T + 1
LONG = 16          # members from which a list is long
CACHE = 400_000    # words whose hash a worker remembers
LIKELY = 28        # agreeing coordinates of a likely pair
LEADERS = 2        # members of a long list that are compared with all others at first
PART = 4096        # members of a list that one task reads at first
BLOCK = 1024       # members of a long list compared with as many others at a time
SHINGLES = 1_000_000  # shingles that a side of such a block holds
FINE = 384         # further coordinates, a byte each, for members of long lists

_rng = np.random.default_rng(20)
_PLACES = _rng.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIPS = _rng.integers(0, 2**63, K, dtype=np.uint64)
_TURNS = _rng.integers(0, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FINE_FLIPS = _rng.integers(0, 2**32, FINE, dtype=np.uint32)
_FINE_TURNS = _rng.integers(0, 2**31, FINE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def needed(coordinates: int, percent: int) -> int:
    """Agreeing coordinates that a pair at the similarity falls short of only 4.5 deviations below its mean."""
    p = percent / 100
    return int(coordinates * p - 4.5 * (coordinates * p * (1 - p)) ** 0.5)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(text, width: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(tokens)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, tokens), np.uint64, n)
    used = min(width, n)
    out = np.full(n - used + 1, used, np.uint64)
    for k in range(used):
        out += h[k:n - used + 1 + k] * _PLACES[k]
    return np.unique(_mix(out))


def _signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = (shingles[None, at:at + 2048] ^ _FLIPS[:, None]) * _TURNS[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return _mix(low + np.arange(K, dtype=np.uint64))


def _fine(shingles: np.ndarray) -> bytes:
    low = np.full(FINE, np.iinfo(np.uint32).max, np.uint32)
    half = (shingles >> np.uint64(16)).astype(np.uint32)
    for at in range(0, len(half), 1024):
        part = (half[None, at:at + 1024] ^ _FINE_FLIPS[:, None]) * _FINE_TURNS[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """Per row: doc_id, tag (hash of the text), n_shingles, digest of the set, prefix posting keys, one byte of every coordinate, and of the further ones."""
    small_batches(docs.sparkSession)

    def sets(batches):
        cache = _WordHashes()
        for batch in batches:
            n, digest, keys, marks, fine = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, width, cache)
                sig = _signature(s) if len(s) else np.zeros(K, np.uint64)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                keys.append(sig[:PREFIX].view(np.int64))
                marks.append(sig.astype(np.uint8).tobytes())
                fine.append(_fine(s))
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            offsets = pa.array(np.arange(0, (len(n) + 1) * PREFIX, PREFIX, dtype=np.int32)[:len(n) + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(offsets, flat), pa.array(marks, pa.binary()),
                 pa.array(fine, pa.binary())],
                ["doc_id", "tag", "n_shingles", "digest", "keys", "marks", "fine"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(text_col).alias("tag"))
    return picked.mapInArrow(releasing(sets), "doc_id long, tag long, n_shingles long, digest binary, keys array<long>, "
                             "marks binary, fine binary")


def _agreeing(marks, n, coordinate, left, right, percent, least=T, every=False):
    """Of index pairs (left, right): those whose sizes allow the similarity,
    that agree on at least ``least`` coordinates, and (unless ``every``) whose
    list is among the first two they share, so a pair is emitted a few times at most."""
    small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
    ok = 100 * small >= percent * large
    left, right = left[ok], right[ok]
    same = marks[left] == marks[right]
    ok = same.sum(axis=1) >= least
    if every:
        return left[ok], right[ok]
    earlier = (same[:, :PREFIX] & (np.arange(PREFIX)[None, :] < coordinate[left][:, None])).sum(axis=1)
    ok &= earlier < 2
    return left[ok], right[ok]


def _runs(batches):
    """Batches sorted by key -> tables in which no key's rows are cut in two."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        key = batch.column("key")
        if key[-1].as_py() == held[0].column("key")[0].as_py():
            continue  # still one key: wait for its end
        table = pa.Table.from_batches(held)
        last = key.to_numpy()
        cut = table.num_rows - int((last == last[-1]).sum())
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _columns(table):
    key, ids, n = (table.column(c).to_numpy() for c in ("key", "id", "n"))
    marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, K)
    return key, ids, n, table.column("at").to_numpy(), marks


def _starts(key):
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return edge, np.diff(np.append(edge, len(key)))


def _short_and_first(percent):
    """Pairs of short lists, likely (leader, member) pairs of long lists, and the long lists' rows."""
    def run(batches):
        for table in _runs(batches):
            key, ids, n, at, marks = _columns(table)
            lists = table.column("list").to_numpy()
            edge, size = _starts(key)
            lefts, rights, long_rows = [], [], []
            for s in np.unique(size[size > 1]):
                begin = edge[size == s]
                if s <= LONG:
                    i, j = np.triu_indices(int(s), 1)
                    step = max(1, 400_000 // len(i))
                    for a in range(0, len(begin), step):
                        part = begin[a:a + step, None]
                        got = _agreeing(marks, n, at, (part + i).ravel(), (part + j).ravel(), percent)
                        lefts.append(got[0]), rights.append(got[1])
                else:
                    for b in begin:
                        members = np.arange(b, b + s)
                        order = np.argsort(_mix(ids[members].view(np.uint64) ^ key[b:b + 1].view(np.uint64)))
                        for leader in members[order[:LEADERS]]:
                            got = _agreeing(marks, n, at, np.full(s, leader), members, percent, LIKELY, True)
                            lefts.append(got[0]), rights.append(got[1])
                        long_rows.append(members)
            if lefts:
                left, right = np.concatenate(lefts), np.concatenate(rights)
                a, b = np.minimum(ids[left], ids[right]), np.maximum(ids[left], ids[right])
                pairs = np.unique(np.stack([a, b], 1), axis=0)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                yield _out(pairs[:, 0], pairs[:, 1])
            if long_rows:
                rows = np.concatenate(long_rows)
                yield _out(ids[rows], None, lists[rows], n[rows], at[rows])
    return run


def _out(a, b, key=None, n=None, at=None):
    size = len(a)
    put = lambda v, kind: pa.nulls(size, kind) if v is None else pa.array(v, kind)
    return pa.RecordBatch.from_arrays(
        [put(a, pa.int64()), put(b, pa.int64()), put(key, pa.int64()), put(n, pa.int32()), put(at, pa.int32())],
        ["a", "b", "key", "n", "at"])


def dealt(postings: DataFrame) -> DataFrame:
    """``postings`` with ``list`` (their key) and as ``key`` the part of the list that
    one task reads: the list itself up to ``PART`` members, else a seeded share of it."""
    hot = staged(postings.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > PART), "near-hot")
    parts = F.ceil(F.col("m") / PART).cast("bigint")
    part = F.xxhash64("key", F.pmod(F.xxhash64("id", "key"), parts))
    return postings.join(hot, "key", "left").withColumn("list", F.col("key")).withColumn(
        "key", F.when(F.col("m").isNotNull(), part).otherwise(F.col("key"))).drop("m")


def open_blocks(members: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Rows (key, own, id, n, at, comp) of cut lists -> the comparisons still to make:
    ``key`` is a block of about ``BLOCK`` members (``left`` false) and as many rows outside
    the list's largest component (``left`` true). Lists within one component are gone.
    ``names``: columns by id that the rows carry on, joined before a row is copied to its blocks."""
    sized = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"), F.max("own").alias("own"))
    parts = lambda rows, shingles: F.ceil(F.greatest(rows / BLOCK, shingles / SHINGLES)).cast("bigint")
    lists = staged(sized.groupBy("key").agg(F.max(F.struct("c", "comp", "w")).alias("top"), F.sum("c").alias("m"),
                                            F.sum("w").alias("w"), F.max("own").alias("any"))
                   .filter((F.col("m") > F.col("top.c")) & F.col("any"))
                   .select("key", F.col("top.comp").alias("most"), parts(F.col("m") - F.col("top.c"), F.col("w") - F.col("top.w")).alias("nx"),
                           parts(F.col("m"), F.col("w")).alias("ny")), "near-open")
    rows = members.join(lists, "key").withColumn("outside", F.col("comp") != F.col("most"))
    carried = []
    if names is not None:
        carried = [c for c in names.columns if c != "id"]
        rows = rows.join(names, "id")
    nx, ny, zero = F.col("nx"), F.col("ny"), F.lit(0).cast("bigint")
    x, y = F.pmod(F.xxhash64("id", "key", F.lit(1)), nx), F.pmod(F.xxhash64("id", "key", F.lit(2)), ny)
    as_member = F.transform(F.sequence(zero, nx - 1), lambda k: F.struct(k.alias("x"), y.alias("y"), F.lit(False).alias("left")))
    as_left = F.transform(F.sequence(zero, ny - 1), lambda k: F.struct(x.alias("x"), k.alias("y"), F.lit(True).alias("left")))
    places = F.when(F.col("outside"), F.concat(as_member, as_left)).otherwise(as_member)
    kept = ["own", "id", "n", "at", "comp", "outside", *carried]
    return rows.select(F.explode(places).alias("p"), "key", *kept).select(
        F.xxhash64("key", "p.x", "p.y").alias("key"), "p.left", *kept)


def _block_pairs(table, percent):
    """Pairs of row numbers (left, member) of each block, a few thousand at a time: rows in different
    components, whose first shared list this is, and whose further coordinates agree often enough."""
    first, least = needed(64, percent), needed(FINE, percent)
    key, ids, n, at = (table.column(c).to_numpy() for c in ("key", "id", "n", "at"))
    comp, own = table.column("comp").to_numpy(), table.column("own").to_numpy(zero_copy_only=False)
    fine = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
    keys = np.array(table.column("keys").to_pylist(), np.int64).reshape(-1, PREFIX)
    outside, left = (table.column(c).to_numpy(zero_copy_only=False) for c in ("outside", "left"))
    for b, s in zip(*_starts(key)):
        rows = np.arange(b, b + s)
        lefts, members = rows[left[rows]], rows[~left[rows]]
        for x in range(0, len(lefts), BLOCK):
            block = lefts[x:x + BLOCK]
            for y in range(0, len(members), BLOCK):
                other = members[y:y + BLOCK]
                apart = (comp[block][:, None] != comp[other][None, :]) & (own[block][:, None] | own[other][None, :])
                # two rows outside the largest component meet twice
                apart &= ~outside[other][None, :] | (ids[block][:, None] < ids[other][None, :])
                i, j = np.nonzero(apart)
                i, j = block[i], other[j]
                ok = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                i, j = i[ok], j[ok]
                for z in range(0, len(i), 50_000):
                    l, r = i[z:z + 50_000], j[z:z + 50_000]
                    ok = (fine[l, :64] == fine[r, :64]).sum(axis=1) >= first
                    l, r = l[ok], r[ok]
                    ok = (fine[l] == fine[r]).sum(axis=1) >= least
                    l, r = l[ok], r[ok]
                    before = np.arange(PREFIX)[None, :] < at[l][:, None]
                    ok = ~((keys[l] == keys[r]) & before).any(axis=1)
                    if ok.any():
                        yield b, l[ok], r[ok]


def _involved(percent):
    """The rows of blocks that are in a pair still to be confirmed."""
    def run(batches):
        for table in _runs(batches):
            met = np.zeros(table.num_rows, bool)
            for _, left, right in _block_pairs(table, percent):
                met[left] = met[right] = True
            if met.any():
                yield from table.filter(pa.array(met)).combine_chunks().to_batches()
    return run


def _common(one: np.ndarray, sets: list) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others."""
    many = np.concatenate(sets)
    at = np.minimum(np.searchsorted(one, many), len(one) - 1)
    return np.add.reduceat((one[at] == many).astype(np.int64), np.cumsum([0, *map(len, sets[:-1])]))


def _linked(percent):
    """Links (a, b) that join components inside a block, confirmed on full shingle sets."""
    def run(batches):
        for table in _runs(batches):
            ids, comp = table.column("id").to_numpy(), table.column("comp").to_numpy()
            held = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            block, joined, a, b = None, {}, [], []

            def root(c):
                while (up := joined.get(c, c)) != c:
                    joined[c] = c = joined.get(up, up)
                return c

            for start, left, right in _block_pairs(table, percent):
                if start != block:
                    block, joined = start, {}
                for l in np.unique(left):
                    others = right[left == l].tolist()
                    for z in range(0, len(others), 64):
                        some = [r for r in others[z:z + 64] if root(comp[r]) != root(comp[l])]
                        if not some:
                            continue
                        common = _common(held[l], [held[r] for r in some])
                        for r, c in zip(some, common.tolist()):
                            if 100 * c >= percent * (len(held[l]) + len(held[r]) - c) and root(comp[r]) != root(comp[l]):
                                joined[root(comp[r])] = root(comp[l])
                                a.append(min(ids[l], ids[r])), b.append(max(ids[l], ids[r]))
            if a:
                yield _out(np.array(a), np.array(b))
    return run


def shingle_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, shingles): the full sets of the documents ``ids``, sorted 64-bit hashes."""
    def sets(batches):
        cache = _WordHashes()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingle_set(t, width, cache).tobytes() for t in batch.column(1).to_pylist()], pa.binary())],
                ["id", "shingles"])

    return docs.join(ids, docs["doc_id"] == ids["id"]).select("id", "text").mapInArrow(releasing(sets), "id long, shingles binary")


_OUT = "a long, b long, key long, n int, at int"


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of candidate pairs (a, b): those whose full shingle sets meet the similarity."""
    texts = docs.select(F.col("doc_id").alias("node"), "text")
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b"))

    def confirm(batches):
        cache, known = _WordHashes(), {}

        def one(node, text):
            tag = (node, len(text or ""))
            if tag not in known:
                if len(known) >= 64:
                    known.clear()
                known[tag] = shingle_set(text, width, cache)
            return known[tag]

        for batch in batches:
            a, b, left, right = (batch.column(c).to_pylist() for c in ("a", "b", "left", "right"))
            keep = []
            for i in range(len(a)):
                x, y = one(a[i], left[i]), one(b[i], right[i])
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)],
                                             ["a", "b"])

    return both.select("a", "b", "left", "right").mapInArrow(releasing(confirm), "a long, b long").dropDuplicates(["a", "b"])


def components(links: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(node, comp): the smallest node reachable over ``links`` (a, b), for every
    linked node. Alternating large-star and small-star steps; each step's edges
    are written to the shared folder, and the loop ends when a step changes nothing."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    edges = staged(edges.dropDuplicates(["u", "v"]), name)
    before = None
    for _ in range(rounds):
        # large star: every larger neighbour of u goes to u's smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), name)
        large = staged(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .filter("u <> v").dropDuplicates(["u", "v"]), name)
        # small star: u and its smaller neighbours go to the smallest of them
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), name)
        near = large.join(low, "u")
        edges = staged(near.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                       .unionByName(low.select("u", F.col("m").alias("v"))).dropDuplicates(["u", "v"]), name)
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # a star: every node but the centre has one edge, to the smallest node
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")))
            .groupBy("node").agg(F.min("comp").alias("comp")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                    percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, tag (hash of the text), n_shingles, component_id, kept (``percent`` 80 or more)."""
    if percent < 80:
        raise ValueError("the coordinates are laid out for similarities of 0.8 and more")
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = staged(document_sets(own, width=width), "near-sets")
    classes = (sets.filter("doc_id is not null and n_shingles > 0").groupBy("digest")
               .agg(F.min("doc_id").alias("id"), F.first("n_shingles").cast("int").alias("n"),
                    F.first("keys").alias("keys"), F.first("marks").alias("marks"), F.first("fine").alias("fine")))
    # name of every set, by a join that can split a set held by many documents
    names = staged(classes, "near-classes")
    postings = names.select("id", "n", "marks", F.posexplode("keys").alias("at", "key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = staged(dealt(postings.select("key", "id", "n", "at", "marks")).repartition(parts, "key")
                   .sortWithinPartitions("key", "n", "id").mapInArrow(releasing(_short_and_first(percent)), _OUT), "near-lists")
    candidates = staged(found.filter("key is null").select("a", "b").dropDuplicates(["a", "b"]), "near-pairs")
    links = staged(confirmed(candidates, own, width, percent), "near-links")
    comps = components(links)
    long_rows = found.filter("key is not null")
    if not long_rows.isEmpty():
        comps = staged(comps, "near-first")
        # sizes within a factor of 100 / percent fall in the same or in neighbouring bands
        band = F.floor(F.log("n") / F.lit(float(np.log(100 / percent)))).cast("long")
        sides = F.explode(F.array(*[F.struct((band + d).alias("band"), F.lit(d == 0).alias("own")) for d in (0, 1)]))
        members = staged(long_rows.select(F.col("a").alias("id"), "key", "n", "at")
                         .join(comps, F.col("id") == F.col("node"), "left")
                         .select(sides.alias("side"), "key", "id", "n", "at", F.coalesce("comp", "id").alias("comp"))
                         .select(F.xxhash64("key", "side.band").alias("key"), "side.own", "id", "n", "at", "comp"),
                         "near-members")
        blocks = open_blocks(members, names.select("id", "keys", "fine"))
        in_order = lambda df: df.repartition(parts, "key").sortWithinPartitions("key", "n", "id")
        involved = staged(in_order(blocks).mapInArrow(releasing(_involved(percent)), blocks.schema), "near-involved")
        full = staged(shingle_sets(own, involved.select("id").distinct(), width), "near-shingles")
        more = staged(in_order(involved.join(full, "id")).mapInArrow(releasing(_linked(percent)), _OUT).select("a", "b")
                      .dropDuplicates(["a", "b"]), "near-more")
        comps = components(links.unionByName(more))
    named = sets.select("doc_id", "tag", "n_shingles", "digest").join(
        names.select("digest", "id"), "digest", "left")
    located = named.join(comps, F.col("id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "id", "doc_id"))
    return located.select("doc_id", "tag", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
             percent: int = 80) -> DataFrame:
    """Rows of ``docs`` packed in ``row``, without all but one document of each
    group; of rows that agree in doc_id and text one stays; every row without a doc_id stays."""
    goes = near_duplicates(docs, id_col, text_col, width, percent).filter(~F.col("kept")).select(
        F.col("doc_id").alias("id"), "tag").distinct()
    packed = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tag"),
                         F.md5(F.col(text_col)).alias("digest"), F.struct("*").alias("row"))
    named = packed.filter("id is not null").join(goes, ["id", "tag"], "left_anti").dropDuplicates(["id", "digest"])
    return named.select("row").unionByName(packed.filter("id is null").select("row"))
