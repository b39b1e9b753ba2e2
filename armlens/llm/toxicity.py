"""Toxicity by multiple-instance learning (operator 3).

A document is a bag of sentences. A sentence scores ``p = sigmoid(b + sum of
its words' weights)``; the document scores by noisy-or, ``1 - prod(1 - p)``.
Only document labels are known, and the weights are fitted by gradient descent
on the document likelihood, so the model learns which sentences offend.

Words are lower-cased (A-Z), stripped of punctuation and hashed, with their
prefixes of 4 to 6 characters, into ``2**BITS`` weights. A sentence ends at a word ending in ``. ! ?`` or at a line
break. The fit uses at most ``sample_docs`` labelled documents per class (the
smallest seeded hashes of doc_id), in one task; scoring reads every whole text.

Defined cases: NULL text scores like an empty one, ``sigmoid(b)`` of a single
empty sentence; NULL doc_id is never a training row and is not held out;
repeated label rows of a document count as toxic if any is; repeated documents
score alike; without labels of both classes every score is 0. Input columns
other than the id and text are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armlens.llm.common import releasing, small_batches

BITS = 18
PUNCT = b".,;:!?\"'()[]{}"
LINE = b"\x00"  # marks a line break among the words
CACHE = 400_000  # words a worker remembers


class _Vocabulary(dict):
    """word -> row of ``features`` (the word itself and its prefixes of four,
    five and six characters, so inflected forms share weight; 0: none),
    ``ends`` (it ends a sentence) and ``counts`` (it is a word, not a line break)."""

    def __init__(self):
        super().__init__()
        self.features, self.ends, self.counts = [], [], []

    def __missing__(self, word: bytes) -> int:
        core = b"" if word == LINE else word.strip(PUNCT)
        row = [0, 0, 0, 0]
        if core:
            text = core.decode("utf-8", "replace")
            row = [_feature(b"w" + core)] + [_feature(b"p" + text[:k].encode()) if len(text) >= k else 0
                                             for k in (4, 5, 6)]
        self.features.append(row)
        self.ends.append(word == LINE or word[-1:] in (b".", b"!", b"?"))
        self.counts.append(word != LINE)
        self[word] = at = len(self.ends) - 1
        return at

    def arrays(self):
        return (np.array(self.features, np.int64).reshape(-1, 4), np.array(self.ends, np.int64),
                np.array(self.counts, bool))


def _feature(key: bytes) -> int:
    return 1 + xxhash.xxh64_intdigest(key, 3) % ((1 << BITS) - 1)


def _rows(text, vocabulary: _Vocabulary) -> np.ndarray:
    if not text:
        return np.empty(0, np.int64)
    tokens = text.encode("utf-8", "surrogatepass").replace(LINE, b" ").lower().replace(b"\n", b" \x00 ").split()
    return np.fromiter(map(vocabulary.__getitem__, tokens), np.int64, len(tokens))


def _bags(texts, vocabulary):
    """Vocabulary rows of all texts, the sentence of each, the document of every
    sentence, and each text's first row. Every document has at least one
    (possibly empty) sentence."""
    rows = [_rows(t, vocabulary) for t in texts]
    _, ends, _ = vocabulary.arrays()
    sizes = np.array([len(c) for c in rows], np.int64)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    upto = np.concatenate([[0], np.cumsum(ends[flat])]).astype(np.int64)
    stop = np.cumsum(sizes)
    start = stop - sizes
    # sentences of a document: its end marks, plus one for what follows the last mark
    per_doc = upto[stop] - upto[start] + 1
    first = np.concatenate([[0], np.cumsum(per_doc)])[:-1]
    doc_of_row = np.repeat(np.arange(len(rows)), sizes)
    sentence = first[doc_of_row] + (upto[:-1] - upto[start][doc_of_row])
    return flat, sentence, np.repeat(np.arange(len(rows)), per_doc), start


def _fit(texts, labels, epochs: int, rate: float, min_z: float):
    """Weights by feature and the bias. Only words that go with the label are
    given a weight: their document counts by class differ by ``min_z`` standard
    deviations. The others keep zero, so unseen and neutral words say nothing."""
    vocabulary = _Vocabulary()
    flat, sentence, doc, _ = _bags(texts, vocabulary)
    feature = vocabulary.arrays()[0][flat]
    kept = feature > 0
    feature, sentence = feature[kept], np.repeat(sentence, 4).reshape(-1, 4)[kept]
    y = np.asarray(labels, np.float64)
    pair = np.unique(feature * np.int64(len(y)) + doc[sentence])
    docs_with = np.bincount(pair // len(y), minlength=1 << BITS)
    toxic_with = np.bincount(pair // len(y), y[pair % len(y)], 1 << BITS)
    share = y.mean()
    z = (toxic_with - share * docs_with) / np.sqrt(np.maximum(docs_with, 1) * share * (1 - share))
    odds = np.log((toxic_with + 0.5) / (y.sum() + 1)) - np.log((docs_with - toxic_with + 0.5) / (len(y) - y.sum() + 1))
    chosen = np.flatnonzero((np.abs(z) >= min_z) & (np.abs(odds) >= 1))
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    used = place[feature] >= 0
    feature, sentence, n = place[feature[used]], sentence[used], len(chosen)
    w, b = odds[chosen].copy(), -6.0
    mean, var = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, epochs + 1):
        z = b + np.bincount(sentence, w[feature], len(doc))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        clean = np.exp(-np.bincount(doc, np.logaddexp(0, z), len(y)))  # P(no sentence offends)
        pull = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        dz = np.clip(pull[doc] * p, -1, 1)
        grad = np.append(np.bincount(feature, dz[sentence], n) + 0.01 * w, dz.sum())
        mean = 0.9 * mean + 0.1 * grad
        var = 0.99 * var + 0.01 * grad * grad
        move = rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(var / (1 - 0.99 ** step)) + 1e-6)
        w, b = w - move[:-1], b - move[-1]
    out = np.zeros(1 << BITS)
    out[chosen] = w
    return out, b


@dataclass(frozen=True)
class ToxicityModel:
    """Non-zero weights by feature and the sentence bias (``bias=None``: never fitted)."""
    features: np.ndarray
    values: np.ndarray
    bias: float | None

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS)
        w[self.features] = self.values
        return w


def holds_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_docs: int = 4000, epochs: int = 80, rate: float = 0.1,
          min_z: float = 5.0) -> ToxicityModel:
    """Fit on at most ``sample_docs`` labelled documents of each class outside the held-out fold."""
    small_batches(docs.sparkSession)
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"))
             .filter(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~holds_out(F.col("_id")))
             .groupBy("_id").agg(F.max("_y").alias("_y")))
    picked = None
    for y in (0, 1):
        part = known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id", F.lit("sample")), "_id").limit(sample_docs)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * sample_docs ids: a proven bound
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(picked), "_id").dropDuplicates(["_id"]))

    def fit(batches):
        got = sorted((r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3)))),
                     key=lambda r: r[0])
        if len({r[2] for r in got}) == 2:
            w, b = _fit([r[1] for r in got], [r[2] for r in got], epochs, rate, min_z)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_pydict({"f": [at.tolist()], "v": [w[at].tolist()], "b": [float(b)]})

    model = rows.select("_id", "_text", "_y").repartition(1).mapInArrow(
        releasing(fit), "f array<long>, v array<double>, b double").collect()
    if not model:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), None)
    return ToxicityModel(np.asarray(model[0].f, np.int64), np.asarray(model[0].v), model[0].b)


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
                    offending_from: float = 0.5) -> DataFrame:
    """Rows of ``docs`` packed in ``row`` with ``score``, ``predicted`` and the
    ``offending`` sentences as (first_word, n_words, score), words counted from 0."""
    small_batches(docs.sparkSession)
    packed = docs.select(F.col(text_col).alias("_text"), F.struct("*").alias("row"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**BITS weights
    spans = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("score", pa.float64())]))

    def score(batches):
        m, vocabulary = shipped.value, _Vocabulary()
        w = m.dense()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [[] for _ in texts]
            if m.bias is None:
                total = np.zeros(len(texts))
            else:
                if len(vocabulary) > CACHE:
                    vocabulary = _Vocabulary()
                flat, sentence, doc, start = _bags(texts, vocabulary)
                features, _, counts = vocabulary.arrays()
                is_word = counts[flat]
                z = m.bias + np.bincount(sentence, w[features].sum(axis=1)[flat], len(doc))
                total = -np.expm1(-np.bincount(doc, np.logaddexp(0, z), len(texts)))
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                if len(hot := np.flatnonzero(p >= offending_from)):
                    before = np.concatenate([[0], np.cumsum(is_word)])
                    lo, hi = np.searchsorted(sentence, hot), np.searchsorted(sentence, hot, "right")
                    for s, a, z_ in zip(hot, lo, hi):
                        d = doc[s]
                        found[d].append({"first_word": int(before[a] - before[start[d]]),
                                         "n_words": int(before[z_] - before[a]), "score": float(p[s])})
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(total, pa.float64()), pa.array((total >= 0.5).astype(np.int32)),
                 pa.array(found, spans)], ["row", "score", "predicted", "offending"])

    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()),
                           T.StructField("offending", T.ArrayType(T.StructType([
                               T.StructField("first_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
                               T.StructField("score", T.DoubleType())])))])
    return packed.mapInArrow(releasing(score), schema)
