"""Line dedup by content-defined chunks and repeated passages (operator 7, DataFrame functions only).

A text is cut into lines (``\\n``), and the lines into chunks. A boundary lies
before line i when a rolling hash over the hashes of lines i-1 and i falls in a
fixed residue class, so an inserted or removed line moves only the boundaries
next to it. A line of at least ``alone_words`` words is a chunk by itself. A
chunk counts when it has at least two lines that hold a word, or is such a long
line. Of every counting chunk that occurs more than once over all documents the
first occurrence (smallest doc_id, then position) stays, the others go.

Boundaries next to a passage's edges depend on the text around it, so chunks
alone leave its edges, and short passages whole. ``dedup_passages`` therefore
also posts windows that need no context: from every worded line the shortest run
of lines onward, and the shortest run back, with at least two worded lines and
``alone_words`` words. Of every window that occurs more than once the first
occurrence stays, the others go, unless they overlap it. A passage of several
lines and at least that many words is exactly the union of the windows in it,
so a line goes if and only if it lies in a run of lines of that size which
occurs verbatim at an earlier place, or in a repeated chunk. Of every line that
goes an equal one stays. ``dedup_lines`` removes the repeated chunks only.

Equal hashes only propose a repeat: the bytes of all pieces (chunks, windows)
with one hash are compared, and a hash shared by different texts is split by text.

Plan: (1) piece hashes are counted, pre-aggregated before the shuffle; (2) only
pieces whose hash repeats are read again with their text and compared; (3) the
lines to remove join the documents back. The hot piece of a passage that a
third of all documents share is one pre-aggregated row in (1) and in (2), and
its occurrences meet that row in a join whose large partitions can be split.

Defined cases: a NULL text has no lines and stays NULL; an empty text stays
empty; a text that loses every line becomes empty; rows that agree in doc_id
and text count as one document and get the same result each; NULL doc_ids sort
last, then by text hash; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import staged, words

MODULUS = 3  # a boundary on average every MODULUS lines


def _lines(text: Column) -> Column:
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def _described(lines: Column, alone_words: int) -> Column:
    """Per line: its text, hash, number of words, and whether it is long."""
    counted = F.transform(lines, lambda x: F.struct(x.alias("t"), F.xxhash64(x).alias("h"), F.size(words(x)).alias("w")))
    return F.transform(counted, lambda x: F.struct(x["t"].alias("t"), x["h"].alias("h"), x["w"].alias("w"),
                                                   (x["w"] >= alone_words).alias("long")))


def chunked(text: Column, alone_words: int = 50) -> Column:
    """Chunks of a text, in order, as struct(first, lines, counts): index of the
    first line, its lines, whether it may be removed."""
    return F.transform(F.array(_described(_lines(text), alone_words)), lambda d: _cut(d))[0]


def _cut(d: Column) -> Column:
    n = F.size(d)
    index = F.sequence(F.lit(0), n - 1)

    def opens(i):
        prior = F.get(d, i - 1)
        here = F.get(d, i)
        rolled = F.pmod(F.xxhash64(prior["h"], here["h"]), F.lit(MODULUS)) == 0
        return (i == 0) | here["long"] | prior["long"] | rolled

    starts = F.when(n > 0, F.filter(index, opens)).otherwise(F.array().cast("array<int>"))

    def chunk(s, k, all_starts):
        stop = F.coalesce(F.get(all_starts, k + 1), n)
        part = F.slice(d, s + 1, stop - s)
        spoken = F.size(F.filter(part, lambda x: x["w"] > 0))
        return F.struct(s.alias("first"), part["t"].alias("lines"),
                        ((spoken >= 2) | F.exists(part, lambda x: x["long"])).alias("counts"))

    return F.transform(F.array(starts), lambda a: F.transform(a, lambda s, k: chunk(s, k, a)))[0]


def _windows(d: Column, least: int) -> Column:
    """Spans (first, size) of the shortest runs of lines onward and back from every worded
    line that hold two worded lines and ``least`` words. Such a run has ``least`` worded lines at most."""
    spoken = F.filter(F.transform(d, lambda x, i: F.struct(i.alias("i"), x["w"].alias("w"))), lambda x: x["w"] > 0)
    none = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"), F.lit(-1).alias("i"))

    def full(acc):
        return (acc["w"] >= least) & (acc["n"] >= 2)

    def step(acc, y):
        return F.when(full(acc), acc).otherwise(F.struct(
            (acc["w"] + y["w"]).alias("w"), (acc["n"] + 1).alias("n"), y["i"].alias("i")))

    def runs(v):
        def run(x, k):
            reached = F.aggregate(F.slice(v, k + 1, max(least, 2)), none, step)
            return F.transform(F.array(reached), lambda r: F.when(full(r), F.struct(
                F.least(x["i"], r["i"]).alias("first"), (F.abs(r["i"] - x["i"]) + 1).alias("size"))))[0]
        return F.filter(F.transform(v, run), lambda x: x.isNotNull())

    return F.transform(F.array(spoken), lambda v: F.concat(runs(v), runs(F.reverse(v))))[0]


def pieces(text: Column, passages: bool, alone_words: int = 50) -> Column:
    """Pieces of a text that go if they repeat, as struct(first, size, hash): the
    counting chunks and, with ``passages``, the windows; a span is listed once."""
    def spans(d):
        chunks = F.transform(F.filter(_cut(d), lambda c: c["counts"]), lambda c: F.struct(
            c["first"].alias("first"), F.size(c["lines"]).alias("size")))
        return F.array_distinct(F.concat(chunks, _windows(d, alone_words))) if passages else chunks

    return F.transform(F.array(_described(_lines(text), alone_words)), lambda d: F.transform(spans(d), lambda s: F.struct(
        s["first"].alias("first"), s["size"].alias("size"),
        F.xxhash64(F.slice(d["h"], s["first"] + 1, s["size"])).alias("hash"))))[0]


def repeated_pieces(keyed: DataFrame, passages: bool) -> DataFrame:
    """(id, tag, ps): per document the pieces (first, size) to remove.

    ``keyed``: rows (id, tag, text) whose key (id, tag) is never NULL."""
    light = staged(keyed.select("id", "tag", F.explode_outer(pieces(F.col("text"), passages)).alias("p"))
                   .filter("p is not null").select("id", "tag", "p.*"), "pieces")
    again = staged(light.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"),
                   "piece-hashes")
    suspects = light.join(again, "hash").groupBy("id", "tag").agg(F.collect_set(F.struct("first", "size", "hash")).alias("ps"))

    def read_again(lines):
        return F.transform("ps", lambda p: F.struct(
            p["first"].alias("first"), p["size"].alias("size"), p["hash"].alias("hash"),
            F.array_join(F.slice(lines, p["first"] + 1, p["size"]), "\n").alias("bytes")))

    read = staged(keyed.join(suspects, ["id", "tag"])
                  .select("id", "tag", F.explode(F.transform(F.array(_lines(F.col("text"))), read_again)[0]).alias("p"))
                  .select("id", "tag", "p.*"), "piece-texts")
    # byte comparison: the texts under each hash, nearly always one
    at = F.struct("id", "tag", "first")
    texts = staged(read.groupBy("hash", "bytes").agg(F.min(at).alias("keep"), F.count(F.lit(1)).alias("n")),
                   "piece-groups")
    shared = staged(texts.groupBy("hash").agg(F.count(F.lit(1)).alias("m"), F.min("keep").alias("keep"), F.sum("n").alias("n"))
                    .filter("m > 1 or n > 1"), "piece-firsts")
    # one text: its hash stands for it; several: each text by its bytes
    one = read.select("id", "tag", "first", "size", "hash").join(shared.filter("m = 1").select("hash", "keep"), "hash")
    several = shared.filter("m > 1").select("hash")
    found = one.drop("hash")
    if not several.isEmpty():
        parted = texts.filter("n > 1").join(several, "hash", "left_semi").select("hash", "bytes", "keep")
        found = found.unionByName(read.join(parted, ["hash", "bytes"]).drop("hash", "bytes"))
    beside = (F.col("id") != F.col("keep.id")) | (F.col("tag") != F.col("keep.tag")) | (
        F.col("first") >= F.col("keep.first") + F.col("size"))
    return found.filter(beside).groupBy("id", "tag").agg(F.collect_set(F.struct("first", "size")).alias("ps"))


def _deduped(docs: DataFrame, id_col: str, text_col: str, passages: bool) -> DataFrame:
    text = F.col("row")[text_col]
    number = F.col(id_col).cast("long")
    packed = docs.select(
        F.coalesce(number, F.lit(2 ** 63 - 1)).alias("id"),
        F.xxhash64(number.isNull(), F.col(text_col)).alias("tag"), F.struct("*").alias("row"))
    goes = repeated_pieces(packed.select("id", "tag", text.alias("text")), passages)
    both = packed.join(goes, ["id", "tag"], "left")
    # an untouched document is not cut again
    lines, touched = _lines(text), F.col("ps").isNotNull()
    gone = F.array_distinct(F.flatten(F.transform("ps", lambda p: F.sequence(p["first"], p["first"] + p["size"] - 1))))
    whole = F.transform(F.array("ps"), lambda ps: F.size(F.filter(chunked(text), lambda c: c["counts"] & F.array_contains(
        ps, F.struct(c["first"].alias("first"), F.size(c["lines"]).alias("size"))))))[0]
    # lines that stay: positions without the removed ones, in order
    stays = F.transform(F.array(lines), lambda ls: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone), lambda i: F.get(ls, i)))[0]
    out = both.select("row", "ps", F.when(touched, stays).alias("stays"), F.when(touched, whole).alias("whole"),
                      F.size(lines).alias("n_lines"))
    return out.select(
        "row", F.when(F.col("ps").isNull(), text).otherwise(F.array_join("stays", "\n")).alias("clean"),
        "n_lines", F.when(F.col("ps").isNull(), 0).otherwise(F.col("n_lines") - F.size("stays")).alias("n_removed"),
        F.coalesce("whole", F.lit(0)).alias("n_chunks"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` packed in ``row`` with ``clean`` (the text without its
    repeated chunks), ``n_lines``, ``n_removed`` (lines) and ``n_chunks`` (removed)."""
    return _deduped(docs, id_col, text_col, False)


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``dedup_lines``, without the repeated passages of several lines too;
    ``n_chunks`` counts the chunks among the removed pieces."""
    return _deduped(docs, id_col, text_col, True)
