"""Fill-in-middle transformation by word-parallel selection in UTF-8 (operator 11).

A text of n code points is cut at two of its n + 1 places into prefix, middle
and suffix and written out with sentinels, so that a model learns to fill in the
middle. The places, and whether a text is cut at all, follow from a hash of its
id, so reruns agree and no state is kept.

A text is never decoded. The bytes of a whole batch are viewed as uint64 words;
shifts and masks mark in every word the bytes that end a UTF-8 unit (the next
byte is no 10xxxxxx), ``bitwise_count`` counts them per word, and a cumulative
search over those counts finds the word that holds the k-th unit of the batch;
inside it a multiplication makes running byte counts that one comparison
resolves. A place costs one search, however long its text.

Defined cases: NULL and empty texts are ``plain`` and give the empty text; so
does a text that holds a sentinel (``plain``, unchanged); a NULL id is hashed as
the empty string; very long texts are cut like any other, a batch holds
``ARROW_BYTES`` of texts or one longer text; repeated rows give equal results;
an empty table gives an empty one; the columns named in ``keep`` pass through
inside ``row``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armlens.llm.common import small_batches

SENTINELS = ("<P>", "<S>", "<M>")  # of prefix, suffix and middle

_ONES = np.uint64(0x0101010101010101)
_TOPS = np.uint64(0x8080808080808080)
_1, _7, _8, _56 = (np.uint64(k) for k in (1, 7, 8, 56))


class Units:
    """Rank and select of the UTF-8 units in one run of bytes."""

    def __init__(self, data: np.ndarray):
        words = np.zeros(len(data) // 8 + 1, "<u8")  # at least one byte of padding
        words.view(np.uint8)[:len(data)] = data
        starts = ~(words & ~(words << _1)) & _TOPS  # top bit of every byte other than 10xxxxxx
        ends = starts >> _8  # a byte ends a unit if the next one starts one
        ends[:-1] |= starts[1:] << _56
        ends.view(np.uint8)[len(data):] = 0
        self.ends = ends
        self.upto = np.cumsum(np.bitwise_count(ends), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Units that end before byte ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = self.ends[word] & ((_1 << (_8 * byte)) - _1)
        before = np.where(word > 0, self.upto[word - 1], 0)
        return before + np.bitwise_count(below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte after the k-th unit, counted from 1; 0 for k = 0."""
        word = np.searchsorted(self.upto, k)
        rest = (k - np.where(word > 0, self.upto[word - 1], 0)).astype(np.uint64)
        running = (self.ends[word] >> _7) * _ONES  # byte j: marks in bytes 0 to j
        reached = ((running | _TOPS) - rest * _ONES) & _TOPS
        return np.where(k > 0, word * 8 + 9 - np.bitwise_count(reached), 0)


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls and the n + 1 offsets into them."""
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _cut(texts: pa.Array, draws: np.ndarray, sentinels: tuple, fim_percent: int, spm_percent: int):
    """Per text: n, form, prefix units, middle units, output bytes."""
    data, offsets = _buffer(texts)
    units = Units(data)
    before = units.rank(offsets)
    n = np.diff(before)
    places = draws[:, :2] % (n + 1)[:, None]
    low, high = places.min(axis=1), places.max(axis=1)
    first, second = units.select(before[:-1] + low), units.select(before[:-1] + high)
    whole = draws[:, 2] % 100 >= fim_percent
    spm = draws[:, 3] % 100 < spm_percent
    held = memoryview(data)
    p, s, m = (x.encode() for x in sentinels)
    forms, outputs = [], []
    for a, b, c, d, plain, turned in zip(offsets[:-1].tolist(), first.tolist(), second.tolist(), offsets[1:].tolist(),
                                         whole.tolist(), spm.tolist()):
        text = bytes(held[a:d])
        if plain or not text or p in text or s in text or m in text:
            forms.append("plain")
            outputs.append(text)
            continue
        prefix, middle, suffix = text[:b - a], text[b - a:c - a], text[c - a:]
        forms.append("spm" if turned else "psm")
        outputs.append(b"".join((s, suffix, p, prefix, m, middle) if turned else (p, prefix, s, suffix, m, middle)))
    return n, forms, low, high - low, outputs


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list | None = None,
              seed: int = 1, sentinels: tuple = SENTINELS, fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` (all) packed in ``row``, n, form,
    prefix_chars, middle_chars, output. Draws are the first four 32-bit groups of
    sha256("seed:id"): two places, whether the text is cut, and the order."""
    small_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])
    own = docs.select(F.struct(*[F.col(c) for c in (docs.columns if keep is None else keep)]).alias("row"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"), draws.alias("draws"))

    def work(batches):
        for batch in batches:
            drawn = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
            n, forms, prefix, middle, outputs = _cut(batch.column(1), drawn, sentinels, fim_percent, spm_percent)
            plain = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain),
                 pa.array(outputs, pa.binary()).cast(pa.string())],
                ["row", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = T.StructType([T.StructField("row", own.schema["row"].dataType), T.StructField("n", T.LongType()),
                           T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
    return own.mapInArrow(work, schema)


def restore(output: Column, form: Column, sentinels: tuple = SENTINELS) -> Column:
    """The text an output was made from. A cut text holds no sentinel, and none
    can arise across a seam, so an output splits at exactly three places."""
    parts = F.split(output, "|".join(rf"\Q{x}\E" for x in sentinels))
    return (F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
            .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
            .otherwise(output))
