"""LM scoring by a hashed maximum-entropy model (operator 5).

Tokens are the lower-cased (A-Z) words of a text, then one end token.

* Counts: every training token is counted (c: count of a token, N: all, V:
  distinct). Counts are summed in each task before the shuffle.
* Classes: the ``ALONE`` most frequent tokens are classes of their own; every
  other token falls in one of ``CLASSES - ALONE`` classes by its last two
  bytes, so unseen tokens have a class too.
* Model: ``P(token | before) = P(class | before) * P(token | class)``. The
  class is a softmax over hashed features of the tokens before: the previous
  one, the pair of the two before, the one two back and the one three back
  (skips), and a bias. Inside a class, ``(c + 1) / (N_class + V_class + 1)``.
* Training: the training documents are dealt into ``ROUNDS`` parts by a hash of
  doc_id. In each round every task runs over its share of one part, takes
  gradient steps (AdaGrad, minibatches) from the common weights, and returns its
  weights; the average, weighted by tokens and summed row by row in Spark, is
  the next common model. Every training token is used once.
* Scoring: sparse numpy batches of many documents at once.

Base score: the sum of ``log10((c + 1) / (N + V + 1))`` over the tokens. Counts of
the ``COMMON`` most frequent tokens (a fixed bound) are sent to all tasks; the
other tokens of a document join the count table by the token, one row for each
distinct pair of document and token.

Defined cases: NULL and empty texts have the end token only; documents without
a doc_id train and are not held out; rows that repeat a doc_id and text are
scored alike; without training tokens N and V are 0 and the model is uniform.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import small_batches, staged

END = "\n"          # no word holds a line break
CLASSES, ALONE = 64, 32
BITS = 14           # hashed features: 2**BITS rows of CLASSES weights
ROUNDS = 2
RATE = 0.15
BATCH = 4096        # tokens of one gradient step
COMMON = 100_000    # tokens whose counts every task holds
CACHE = 400_000


def holds_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _tokens(text) -> list:
    return (text.encode("utf-8", "surrogatepass").lower().split() if text else []) + [b"\n"]


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) of all rows (text); each task sums its own counts first."""
    def count(batches):
        from collections import Counter
        held = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], ["token", "c"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(_tokens(text))
            if len(held) > CACHE:
                yield rows()
                held = Counter()
        if held:
            yield rows()

    return docs.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _tail(token: bytes) -> bytes:
    return token.rstrip(b".,;:!?")[-2:]


def _class_of(tail: bytes) -> int:
    return ALONE + xxhash.xxh32_intdigest(tail, 5) % (CLASSES - ALONE)


def _tail_class(token: bytes) -> int:
    return _class_of(_tail(token))


class _Classes(dict):
    """last two bytes -> class"""

    def __missing__(self, tail: bytes) -> int:
        self[tail] = k = _class_of(tail)
        return k


class _Lexicon(dict):
    """token -> row of (hash, class, count or -1 if it must be looked up)."""

    def __init__(self, common: dict, alone: dict):
        super().__init__()
        self.common, self.alone, self.classes = common, alone, _Classes()
        self.tokens, self.parts = [], [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]

    def rows(self, tokens: list) -> np.ndarray:
        """The rows of distinct tokens; those not met before get new ones."""
        new = [t for t in tokens if t not in self]
        k, held = len(new), len(self)
        if new:
            self.update(zip(new, range(held, held + k)))
            self.tokens += new
            classes = np.fromiter(map(self.classes.__getitem__, map(_tail, new)), np.int64, k)
            for token, own in self.alone.items():
                if (at := self.get(token, -1) - held) >= 0:
                    classes[at] = own
            self.parts.append((np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, k), classes,
                               np.fromiter(map(self.common.get, new, repeat(-1)), np.int64, k)))
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def arrays(self):
        self.parts = [tuple(map(np.concatenate, zip(*self.parts)))]
        return self.parts[0]


_SALT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _features(h: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(tokens, 4) hashed features of what stands before each token in its document."""
    def back(k):
        out = np.zeros(len(h), np.uint64)
        out[k:] = h[:-k]
        for j in range(k):  # less than k tokens stand before a document's first k
            out[start[size > j] + j] = np.uint64(j + 1)
        return out
    one, two, three = back(1), back(2), back(3)
    mix = np.stack([one * _SALT[0], (one * _SALT[1] + two) * _SALT[2], two * _SALT[3], (three ^ _SALT[0]) * _SALT[1]], 1)
    mix ^= mix >> np.uint64(31)
    return ((mix * _SALT[2]) >> np.uint64(64 - BITS)).astype(np.int64)


def _logits(w: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = np.take(w, f[:, 0], axis=0)
    more = np.empty_like(z)
    for k in range(1, f.shape[1]):
        z += np.take(w, f[:, k], axis=0, out=more, mode="clip")  # rows are in range: "clip" writes to ``out`` at once
    z += w[-1]  # the bias row
    return z


def _summed(z: np.ndarray, of: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of the rows ``of`` of ``z`` over the runs (first, size, longest first): what ``np.add.reduceat`` gives, to
    the last bit, but over whole rows and many runs at a time. It adds the first row to the sum of the others, and
    those one after the other (fewer than 8), in 8 interleaved sums (up to 128), or pairwise."""
    rows = lambda places: np.take(z, of[places], axis=0)
    more = size - 1
    over = lambda n: int(np.searchsorted(-more, -n))  # runs with more than n others
    out, eight = rows(first), np.arange(8)
    long, middle, some = over(128), over(7), over(0)
    for k in range(long):
        out[k] += np.add.reduce(np.ascontiguousarray(rows(np.arange(first[k] + 1, first[k] + size[k])).T), axis=1)
    if middle > long:
        at, n = first[long:middle] + 1, more[long:middle]
        whole, left = n - n % 8, n % 8
        r = rows(at[:, None] + eight)
        for i in range(8, 128, 8):
            m = int(np.searchsorted(-whole, -i))
            if not m:
                break
            r[:m] += rows(at[:m, None] + i + eight)
        rest = ((r[:, 0] + r[:, 1]) + (r[:, 2] + r[:, 3])) + ((r[:, 4] + r[:, 5]) + (r[:, 6] + r[:, 7]))
        for j in range(7):
            i = np.flatnonzero(left > j)
            rest[i] += rows(at[i] + whole[i] + j)
        out[long:middle] += rest
    if some > middle:
        at = first[middle:some] + 1
        rest = rows(at)
        for j in range(1, 7):
            m = over(j) - middle
            if m <= 0:
                break
            rest[:m] += rows(at[:m] + j)
        out[middle:some] += rest
    return out


def _train_step(w, g2, f, y):
    z = _logits(w, f)
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    z[np.arange(len(y)), y] -= 1
    rows = np.concatenate([f.T.ravel(), np.full(len(y), len(w) - 1)])
    if len(w) <= 1 << 16:
        rows = rows.astype(np.uint16)  # sorted by radix
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    size = np.diff(np.append(first, len(rows)))
    longest = np.argsort(-size, kind="stable")
    first, size = first[longest], size[longest]
    grads = _summed(z, order % len(y), first, size)
    rows = rows[first].astype(np.int64)
    for a in range(0, len(rows), 256):  # blocks that stay in the processor's cache
        at, grad = rows[a:a + 256], grads[a:a + 256]
        square = np.take(g2, at, axis=0)
        square += grad * grad
        g2[at] = square
        square += np.float32(1e-3)
        np.sqrt(square, out=square)
        grad *= np.float32(RATE)
        grad /= square
        w[at] -= grad


def _flat(texts: pa.StringArray, lexicon):
    """Lexicon rows of the tokens of all texts, and each text's first place and number of tokens."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    found = lists.flatten().dictionary_encode()
    words = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    row = lexicon.rows([*words, b"\n"])
    place = found.indices.to_numpy()
    stops = lists.offsets.to_numpy().astype(np.int64)
    stops -= stops[0]
    if b"" in words:  # what stands beside leading and trailing spaces
        kept = place != words.index(b"")
        place, stops = place[kept], np.append(0, np.cumsum(kept))[stops]
    size = np.diff(stops) + 1
    return np.insert(row[place], stops[1:], row[-1]), np.cumsum(size) - size, size


def train_rounds(docs: DataFrame, alone: dict) -> np.ndarray:
    """The class model's weights. ``docs``: training rows (doc_id, text)."""
    spark = docs.sparkSession
    shape = ((1 << BITS) + 1, CLASSES)
    w = np.zeros(shape, np.float32)
    for turn in range(ROUNDS):
        shipped = spark.sparkContext.broadcast(w)  # a fixed size

        def update(batches):
            mine, g2 = shipped.value.copy(), np.zeros(shape, np.float32)
            lexicon, seen = _Lexicon({}, alone), 0
            for batch in batches:
                if len(lexicon) > CACHE:
                    lexicon = _Lexicon({}, alone)
                flat, start, size = _flat(batch.column(0), lexicon)
                if not len(flat):
                    continue
                h, classes, _ = lexicon.arrays()
                f, y = _features(h[flat], start, size), classes[flat]
                for a in range(0, len(y), BATCH):
                    _train_step(mine, g2, f[a:a + BATCH], y[a:a + BATCH])
                seen += len(y)
            if seen:
                moved = np.flatnonzero(g2.any(axis=1))  # the weights this task changed
                step = ((mine[moved] - shipped.value[moved]) * seen).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(moved, pa.int32()), pa.array(list(step), pa.list_(pa.float32())),
                     pa.array(np.full(len(moved), seen), pa.int64())], ["row", "step", "seen"])

        part = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(ROUNDS)) == turn)
        steps = part.select("text").mapInArrow(update, "row int, step array<float>, seen long")
        # sums by row in Spark: as many rows as the model, whatever the number of tasks
        summed = steps.groupBy("row").agg(
            *[F.sum(F.col("step")[k]).alias(f"s{k}") for k in range(CLASSES)], F.sum("seen").alias("seen")).select(
            "row", F.array(*[F.col(f"s{k}") / F.col("seen") for k in range(CLASSES)]).cast("array<float>").alias("step"))
        got = summed.toPandas()
        if len(got):
            w = w.copy()
            w[got["row"].to_numpy()] += np.stack(got["step"].to_numpy())
        shipped.unpersist()
    return w


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
                    fold: int = 2) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    training = own.filter(~holds_out(F.col("doc_id"), folds, fold))
    counts = staged(token_counts(training), "lm-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, v_all = int(total["n"]), int(total["v"])
    # cut in the cluster first: only the COMMON rows come to the driver
    top = staged(counts.orderBy(F.desc("c"), "token").limit(COMMON), "lm-common").toArrow().sort_by(
        [("c", "descending"), ("token", "ascending")])
    common = dict(zip(top["token"].to_pylist(), top["c"].to_pylist()))
    alone = {token: k for k, token in enumerate(list(common)[:ALONE])}
    # tokens and distinct tokens of every class, over all counts
    def class_sums(batches):
        sums = np.zeros((2, CLASSES), np.int64)
        for batch in batches:
            for token, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k = alone[token] if token in alone else _tail_class(token)
                sums[0, k] += c
                sums[1, k] += 1
        yield pa.RecordBatch.from_pydict({"k": list(range(CLASSES)), "n": sums[0], "v": sums[1]})
    sums = counts.select("token", "c").mapInArrow(class_sums, "k long, n long, v long").groupBy("k").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    room = np.ones(CLASSES)  # N_class + V_class + 1
    for r in sums:
        room[r["k"]] += r["n"] + r["v"]
    weights = train_rounds(training, alone)
    shipped = spark.sparkContext.broadcast((common, alone, weights, np.log10(room)))
    log_base = float(np.log10(n_all + v_all + 1))

    def score(batches):
        common_, alone_, w, log_room = shipped.value
        lexicon = _Lexicon(common_, alone_)
        for batch in batches:
            if len(lexicon) > CACHE:
                lexicon = _Lexicon(common_, alone_)
            texts = batch.column(1)
            flat, start, size = _flat(texts, lexicon)
            h, classes, known = lexicon.arrays()
            f, y = _features(h[flat], start, size), classes[flat]
            log_class = np.empty(len(y))
            for a in range(0, len(y), 1024):
                z = _logits(w, f[a:a + 1024])
                z -= z.max(axis=1, keepdims=True)
                own = z[np.arange(len(z)), y[a:a + 1024]]
                log_class[a:a + 1024] = own - np.log(np.exp(z, out=z).sum(axis=1))
            doc = np.repeat(np.arange(len(texts)), size)
            c = known[flat]
            here = c >= 0
            log_c = np.where(here, np.log10(np.maximum(c, 0) + 1), 0)
            model = np.bincount(doc, log_class / np.log(10) - log_room[y] + log_c, len(texts))
            base = np.bincount(doc, log_c - log_base, len(texts))
            found = np.bincount(doc, here, len(texts)).astype(np.int64)
            # tokens to look up: distinct in each document, with their number
            pair, times = np.unique(doc[~here] * np.int64(len(known)) + flat[~here], return_counts=True)
            ends = np.concatenate([[0], np.cumsum(np.bincount(pair // len(known), minlength=len(texts)))])
            names = [lexicon.tokens[k] for k in (pair % len(known)).tolist()]
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(names, pa.binary()), pa.array(times, pa.int64())], ["token", "times"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int64()),
                 pa.array(found, pa.int64()), pa.array(base), pa.array(model), rare],
                ["doc_id", "tag", "n_tokens", "n_known", "base", "model", "rare"])

    seen = staged(own.select("doc_id", "text", F.xxhash64("text").alias("tag")).mapInArrow(
        score, "doc_id long, tag long, n_tokens long, n_known long, base double, model double, "
               "rare array<struct<token:binary,times:long>>"), "lm-scores")
    # rarer tokens: their count comes from the count table; tokens never seen in training add log10(1)
    pairs = seen.select("doc_id", "tag", F.explode("rare").alias("r")).select("doc_id", "tag", "r.token", "r.times")
    looked = (pairs.join(counts, "token").groupBy("doc_id", "tag")
              .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("gain")))
    copies = seen.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("copies"))  # repeated rows add up alike
    looked = looked.join(copies, looked.doc_id.eqNullSafe(copies.doc_id) & (looked.tag == copies.tag)).select(
        looked.doc_id.alias("lid"), looked.tag.alias("ltag"), (F.col("more") / F.col("copies")).cast("long").alias("more"),
        (F.col("gain") / F.col("copies")).alias("gain"))
    same = F.col("doc_id").eqNullSafe(F.col("lid")) & (F.col("tag") == F.col("ltag"))
    gain = F.coalesce("gain", F.lit(0.0))
    return seen.drop("rare").join(looked, same, "left").select(
        "doc_id", holds_out(F.col("doc_id"), folds, fold).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"), (F.col("model") + gain).alias("score"))
