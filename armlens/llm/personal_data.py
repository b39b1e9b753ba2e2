"""Personal data by base patterns and a skip-chain conditional random field (operator 13).

The base patterns find e-mail addresses, IP addresses, payment cards and phone
numbers and verify them (parts, digits, check digit). They miss what they glue
together: of two card numbers in a row, or a phone number before another number,
neither is found, since one match swallows both and fails. The field labels
tokens instead and adds the spans that the patterns lost.

Field. Nodes are the tokens that hold a digit or ``@``; every other token can
only be outside, so it is a constant of the model and needs no node. A node has
nine labels (outside; first or further token of each kind), log-linear
potentials of its own shape and neighbours, a chain potential with the node or
constant on either side, and skip potentials with the last and next token of the
document that has the same digits (identical) or the same shape (similar): they
carry evidence between distant mentions of one thing. Edges grow with the
tokens, never with pairs. Marginals come from ``ROUNDS`` rounds of damped loopy
message passing over the documents of a batch at once; a document's result does
not depend on the batch. Runs of labels become spans, and an added span is kept
if it passes its kind's own check and overlaps no base span.

Training. Tokens of all documents are labelled by the base spans; those inside a
failed match of several tokens are left out. The potentials maximise the
pseudo-likelihood, so that one row is a token with the labels around it. Equal
rows are counted over all documents; of the distinct rows a share, by hash, of
``TRAIN_ROWS`` rows is fitted in one task (features only, no texts).

Defined cases: NULL and empty texts have no spans; very long texts are read
whole and in linear time (patterns are possessive); repeated rows give equal
results; without any base span in the corpus nothing is added; an empty table
gives an empty one; columns of any name pass through inside ``row``.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armlens.llm.common import small_batches, staged

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # 0 outside, then first and further token of each kind
KIND_OF = np.array([0] + [1 + k for k in range(len(KINDS)) for _ in (0, 1)])
BITS = 14
TRAIN_ROWS = 40_000
ROUNDS = 12
BLOCK_TOKENS = 20_000

# Fixed values of the base rules; runs are possessive or anchored so that a failed match costs its own length.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_EVIDENCE = re.compile(r"[0-9@]")
_SEPARATOR = r"\s,;:!?\"'<>#*$&|=\[\]{}/\\"
_TOKEN = re.compile(rf"(?<![^{_SEPARATOR}])[^{_SEPARATOR}0-9@]*+[0-9@][^{_SEPARATOR}]*+")
_GAP = re.compile(rf"[{_SEPARATOR}]*+")
_WORD_BEFORE = re.compile(rf"([^{_SEPARATOR}]{{1,24}})[{_SEPARATOR}]{{0,4}}\Z")
_DIGIT_RUN = re.compile(r"[0-9]+")
_LETTER_RUN = re.compile(r"[^\W\d_]+")
_CARD_TOKEN = re.compile(r"[^0-9]{0,2}[0-9][0-9-]*[^0-9]{0,3}")
_PHONE_TOKEN = re.compile(r"[+(]{0,2}[0-9][().0-9-]*")
_CORE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "ip": _IP,
         "card": re.compile(r"[0-9](?:[0-9-]*[0-9])?"), "phone": re.compile(r"[+(]*[0-9](?:[().0-9-]*[0-9])?")}


def _digits(text: str) -> str:
    return "".join(_DIGIT_RUN.findall(text))


def _luhn(digits: str) -> bool:
    doubled = "0246813579"
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(int(doubled[int(d)]) for d in digits[-2::-2])) % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    d = _digits(text)
    return 12 <= len(d) <= 19 and _luhn(d)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


_CHECK = {"email": lambda t: True, "ip": _is_ip, "card": _is_card, "phone": _is_phone}


def base_spans(text: str):
    """Verified spans (start, end, kind number) by start, then kind; and the matches that failed."""
    found, failed = [], []
    floor = 0
    for m in _DOMAIN.finditer(text):
        a = m.start()
        while a > floor and text[a - 1] in _LOCAL:
            a -= 1
        if a < m.start():
            found.append((a, m.end(), 0))
            floor = m.end()
    for kind, pattern, check in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        for m in pattern.finditer(text):
            (found if check(m[0]) else failed).append((*m.span(), kind))
    return sorted(found, key=lambda s: (s[0], s[2])), failed


@lru_cache(1 << 16)
def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def _shape(token: str) -> str:
    return _LETTER_RUN.sub("a", _DIGIT_RUN.sub(lambda m: "9" * min(len(m[0]), 20), token))


@dataclass
class Graph:
    """Tokens of some documents: features, allowed labels and edges (i before j)."""
    spans: list
    features: np.ndarray
    allowed: np.ndarray
    chain: np.ndarray
    same: np.ndarray
    similar: np.ndarray


def _allowed(token: str) -> list:
    can = [True] * LABELS
    for k, ok in enumerate(("@" in token, token.count(".") >= 3 and bool(_IP.search(token)),
                            bool(_CARD_TOKEN.fullmatch(token)), bool(_PHONE_TOKEN.fullmatch(token.rstrip(".,"))))):
        can[1 + 2 * k] = can[2 + 2 * k] = ok
    return can


def graph(text: str) -> Graph:
    """Nodes and edges of one text."""
    spans = [m.span() for m in _TOKEN.finditer(text)]
    tokens = [text[a:b] for a, b in spans]
    shapes = [_shape(t) for t in tokens]
    joined = [_GAP.fullmatch(text, spans[i][1], spans[i + 1][0]) is not None for i in range(len(spans) - 1)]
    features, allowed, edges, last = [], [], ([], []), ({}, {})
    for i, (token, shape) in enumerate(zip(tokens, shapes)):
        d = _digits(token)
        before = joined[i - 1] if i else False
        after = joined[i] if i < len(joined) else False
        near = "" if before else _WORD_BEFORE.search(text[max(0, spans[i][0] - 28):spans[i][0]])
        ip = _IP.search(token)
        verified = 12 <= len(d) <= 19 and _luhn(d)
        names = ("bias", "shape " + shape, f"digits {min(len(d), 24)}", f"dots {min(token.count('.'), 5)}",
                 f"at {token.count('@') > 0} mail {_mail(token)}", f"plus {token[0] == '+'}",
                 f"round {'(' in token}{')' in token}", f"dash {min(token.count('-'), 5)}",
                 f"letters {bool(_LETTER_RUN.search(token))}", f"check {verified} {len(d)}",
                 f"ip {bool(ip) and _is_ip(ip[0])}", "left " + (shapes[i - 1] if before else "^"),
                 "right " + (shapes[i + 1] if after else "$"), "word " + (near[1].lower() if near else "-"))
        features.append([_feature(n) for n in names])
        allowed.append(_allowed(token))
        for edge, seen, key in zip(edges, last, ((d if len(d) > 3 else token.lower()), shape)):
            if key in seen:
                edge.append((seen[key], i))
            seen[key] = i
    pairs = [np.array(e, np.int64).reshape(-1, 2) for e in ([(i, i + 1) for i, j in enumerate(joined) if j], *edges)]
    return Graph(spans, np.array(features, np.int64).reshape(-1, 14), np.array(allowed, bool).reshape(-1, LABELS), *pairs)


def _mail(token: str) -> bool:
    m = _DOMAIN.search(token)
    return bool(m) and m.start() > 0


def token_labels(spans: list, found: list, failed: list) -> np.ndarray:
    """Labels that base spans give to tokens; -1 inside a failed match of several tokens."""
    labels = np.zeros(len(spans), np.int64)
    starts, ends = [s[0] for s in spans], [s[1] for s in spans]

    def inside(a, b):
        return int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b))

    for a, b, _ in failed:
        i, j = inside(a, b)
        if j - i > 1:
            labels[i:j] = -1
    for a, b, kind in sorted(found, key=lambda s: (s[1] - s[0], -s[2])):  # the longest span has the last word
        i, j = inside(a, b)
        labels[i:j] = 2 + 2 * kind
        labels[i:i + 1] = 1 + 2 * kind
    return labels


# ---- model -------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """Log potentials: ``local`` (feature, label), ``chain`` (left label, right label), ``same`` and ``similar`` (label, label)."""
    local: np.ndarray
    chain: np.ndarray
    same: np.ndarray
    similar: np.ndarray


def _agreement(both_kind: float, both_outside: float) -> np.ndarray:
    equal = KIND_OF[:, None] == KIND_OF[None, :]
    return np.where(equal, np.where(KIND_OF[:, None] == 0, both_outside, both_kind), 0.0)


def marginals(g: Graph, field: Field, rounds: int = ROUNDS, damping: float = 0.5) -> np.ndarray:
    """Label probabilities of every node by loopy message passing (all edges at once, a fixed number of rounds)."""
    n = len(g.features)
    own = field.local[g.features].sum(axis=1)
    # a side without a node is outside
    linked_left, linked_right = np.zeros(n, bool), np.zeros(n, bool)
    linked_left[g.chain[:, 1]] = True
    linked_right[g.chain[:, 0]] = True
    own = own + np.where(linked_left[:, None], 0, field.chain[0]) + np.where(linked_right[:, None], 0, field.chain[:, 0])
    own = np.where(g.allowed, own, -1e3)
    kinds = [(e, p) for e, p in ((g.chain, field.chain), (g.same, field.same), (g.similar, field.similar)) if len(e)]
    # both directions of every edge: source, target, potential
    flows = [(np.concatenate((e[:, 0], e[:, 1])), np.concatenate((e[:, 1], e[:, 0])), len(e), np.exp(p)) for e, p in kinds]
    messages = [np.zeros((2 * m, LABELS)) for _, _, m, _ in flows]

    def beliefs():
        b = own.copy()
        for (_, to, _, _), msg in zip(flows, messages):
            np.add.at(b, to, msg)
        return b - b.max(axis=1, keepdims=True)

    for _ in range(rounds):
        b = beliefs()
        for k, ((source, _, m, p), msg) in enumerate(zip(flows, messages)):
            without = b[source] - np.concatenate((msg[m:], msg[:m]))  # all but what came back over this edge
            x = np.exp(without - without.max(axis=1, keepdims=True))
            new = np.log(np.maximum(np.concatenate((x[:m] @ p, x[m:] @ p.T)), 1e-300))
            new -= new.max(axis=1, keepdims=True)
            messages[k] = damping * msg + (1 - damping) * new
    b = np.exp(beliefs())
    return b / b.sum(axis=1, keepdims=True)


def _training_rows(text: str) -> list:
    """(features, label, left label, right label, skip evidence) of the tokens with a known neighbourhood."""
    g = graph(text)
    if not g.spans:
        return []
    labels = token_labels(g.spans, *base_spans(text))
    left, right = np.zeros(len(labels), np.int64), np.zeros(len(labels), np.int64)
    left[g.chain[:, 1]] = labels[g.chain[:, 0]]
    right[g.chain[:, 0]] = labels[g.chain[:, 1]]
    skips = [[] for _ in labels]
    for base, edges in ((0, g.same), (1 + len(KINDS), g.similar)):
        for i, j in edges.tolist():
            for a, b in ((i, j), (j, i)):
                if labels[b] >= 0:
                    skips[a].append(base + int(KIND_OF[labels[b]]))
    return [(g.features[i].tolist(), int(labels[i]), int(left[i]), int(right[i]), sorted(skips[i]))
            for i in np.flatnonzero((labels >= 0) & (left >= 0) & (right >= 0)).tolist()]


def _fit(features, labels, left, right, skips, weights, steps: int, rate: float, l2: float) -> Field:
    """Pseudo-likelihood by Adam over all rows a step. ``skips``: how many identical (similar) neighbours of each kind."""
    n, kinds = len(labels), 1 + len(KINDS)
    used, features = np.unique(features, return_inverse=True)
    features = features.reshape(n, -1)
    target = np.zeros((n, LABELS))
    target[np.arange(n), labels] = 1
    share = (weights / weights.sum())[:, None]
    size = len(used) * LABELS
    theta = np.zeros(size + LABELS * LABELS + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    # per label: identical (similar) neighbours that would agree, as kind and as outside
    agree = np.zeros((n, 4, LABELS))
    for side in (0, 1):
        near = skips[:, side * kinds:(side + 1) * kinds]
        agree[:, 2 * side, 1:] = near[:, KIND_OF[1:]]
        agree[:, 2 * side + 1, 0] = near[:, 0]
    flat = features.ravel()
    for step in range(1, steps + 1):
        local = theta[:size].reshape(-1, LABELS)
        chain = theta[size:size + LABELS * LABELS].reshape(LABELS, LABELS)
        z = local[features].sum(axis=1) + chain[left] + chain[:, right].T + np.einsum("nkl,k->nl", agree, theta[-4:])
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = share * (p - target)
        g_local = np.stack([np.bincount(flat, np.repeat(d[:, k], features.shape[1]), len(used)) for k in range(LABELS)], 1)
        g_chain = np.zeros((LABELS, LABELS))
        np.add.at(g_chain, left, d)
        turned = np.zeros((LABELS, LABELS))
        np.add.at(turned, right, d)
        grad = np.concatenate((g_local.ravel(), (g_chain + turned.T).ravel(), np.einsum("nkl,nl->k", agree, d))) + l2 * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        theta -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    local = np.zeros((1 << BITS, LABELS))
    local[used] = theta[:size].reshape(-1, LABELS)
    same, same_out, similar, similar_out = theta[-4:]
    return Field(local, theta[size:size + LABELS * LABELS].reshape(LABELS, LABELS), _agreement(same, same_out),
                 _agreement(similar, similar_out))


def train(docs: DataFrame, text_col: str = "text", train_rows: int = TRAIN_ROWS, steps: int = 150, rate: float = 0.1,
          l2: float = 1e-6) -> Field | None:
    """Field fitted to the base spans of all documents; ``None`` if there are none."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))

    def rows(batches):
        for batch in batches:
            out = [r for t in batch.column(0).to_pylist() for r in _training_rows(t)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32(),
                                                               pa.list_(pa.int32())))],
                    ["features", "label", "left", "right", "skips"])

    key = ["features", "label", "left", "right", "skips"]
    counted = staged(texts.mapInArrow(rows, "features array<int>, label int, left int, right int, skips array<int>")
                     .groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "personal-rows")
    sizes = counted.agg(F.count(F.lit(1)).alias("rows"), F.max("label").alias("any")).first()
    if not sizes["any"]:
        return None
    share = train_rows / max(train_rows, sizes["rows"])
    picked = counted.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)

    def fit(batches):
        got = sorted(tuple(r) for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        if not got:
            return
        f, label, left, right, skip, n = zip(*got)
        near = np.array([np.bincount(s, minlength=2 * (1 + len(KINDS))) if s else [0] * (2 * (1 + len(KINDS)))
                         for s in skip], float)
        field = _fit(np.array(f), np.array(label), np.array(left), np.array(right), near, np.array(n, float),
                     steps, rate, l2)
        parts = (field.local, field.chain, field.same, field.similar)
        yield pa.RecordBatch.from_arrays([pa.array([p.astype("<f8").tobytes()], pa.binary()) for p in parts],
                                         ["local", "chain", "same", "similar"])

    held = picked.select(*key, "n").repartition(1).mapInArrow(
        fit, "local binary, chain binary, same binary, similar binary").collect()  # one row of a fixed size
    if not held:
        return None
    return Field(*(np.frombuffer(x, "<f8").reshape(-1, LABELS) for x in held[0]))


# ---- search ------------------------------------------------------------------------------------------------------

def _stack(graphs: list) -> Graph:
    """Several documents as one graph without edges between them."""
    base = np.cumsum([0] + [len(g.spans) for g in graphs])
    shift = [np.concatenate([getattr(g, e) + b for g, b in zip(graphs, base)]) for e in ("chain", "same", "similar")]
    return Graph([], np.concatenate([g.features for g in graphs]), np.concatenate([g.allowed for g in graphs]), *shift)


def _added(text: str, g: Graph, p: np.ndarray, found: list) -> list:
    """Spans (start, end, kind, probability) that the labels show and no base span touches."""
    labels, out = p.argmax(axis=1), []
    follows = set(g.chain[:, 1].tolist())
    taken = sorted((a, b) for a, b, _ in found)
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.empty(0, int)
    i = 0
    while i < len(labels):
        kind, j = int(KIND_OF[labels[i]]) - 1, i + 1
        if kind >= 0:
            while (j < len(labels) and labels[j] == 2 + 2 * kind and j in follows
                   and text[g.spans[j - 1][1]:g.spans[j][0]] in (" ", "")):
                j += 1
            name = KINDS[kind]
            first = _CORE[name].search(text, g.spans[i][0], g.spans[i][1])
            if first:
                a, b = first.start(), first.end()
                if j > i + 1:
                    tail = list(_CORE[name].finditer(text, g.spans[j - 1][0], g.spans[j - 1][1]))
                    b = tail[-1].end() if tail else b
                k = int(np.searchsorted(starts, b))  # base spans that start before b
                if _CHECK[name](text[a:b]) and not (k and reach[k - 1] > a):
                    out.append((a, b, kind, float(p[np.arange(i, j), labels[i:j]].min())))
        i = j
    return out


def find(docs: DataFrame, field: Field | None, text_col: str = "text", keep: list | None = None,
         redacted: bool = False) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` (all) packed in ``row``, and ``spans`` by start, then kind:
    (kind, start, end in code points, base, p). ``redacted``: also the text with every span replaced by its kind."""
    small_batches(docs.sparkSession)
    own = docs.select(F.struct(*[F.col(c) for c in (docs.columns if keep is None else keep)]).alias("row"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shipped = docs.sparkSession.sparkContext.broadcast(field)  # (2**BITS + 3 * LABELS) * LABELS numbers
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                      ("p", pa.float64())])

    def solve(block, texts, spans, model):
        """Labels of a block of documents; the added spans join the base ones."""
        if not block:
            return
        p = marginals(_stack([g for _, g in block]), model)
        at = 0
        for d, g in block:
            found = spans[d]
            more = _added(texts[d], g, p[at:at + len(g.spans)], [s[:3] for s in found])
            spans[d] = sorted(found + [(a, b, k, False, q) for a, b, k, q in more], key=lambda s: (s[0], s[2], s[1]))
            at += len(g.spans)

    def work(batches):
        model = shipped.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            spans, block, held = [[] for _ in texts], [], 0
            for d, text in enumerate(texts):
                if not _EVIDENCE.search(text):
                    continue
                spans[d] = [(a, b, k, True, 1.0) for a, b, k in base_spans(text)[0]]
                if model is None:
                    continue
                g = graph(text)
                if held and held + len(g.spans) > BLOCK_TOKENS:
                    solve(block, texts, spans, model)
                    block, held = [], 0
                if g.spans:
                    block.append((d, g))
                    held += len(g.spans)
            solve(block, texts, spans, model)
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "base": c, "p": q} for a, b, k, c, q in s] for s in spans]
            columns = [batch.column(0), pa.array(rows, pa.list_(span))]
            if redacted:
                columns.append(pa.array([_redact(t, s) for t, s in zip(texts, spans)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["row", "spans", "redacted"][:len(columns)])

    fields = [T.StructField("row", own.schema["row"].dataType), T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("base", T.BooleanType()), T.StructField("p", T.DoubleType())])))]
    if redacted:
        fields.append(T.StructField("redacted", T.StringType()))
    return own.mapInArrow(work, T.StructType(fields))


def _redact(text: str, spans: list) -> str:
    """Overlapping spans become one replacement, named by the first."""
    out, at, open_to = [], 0, 0
    for a, b, kind, _, _ in spans:
        if a >= open_to:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        open_to = at = max(open_to, b)
    return "".join(out) + text[at:]
