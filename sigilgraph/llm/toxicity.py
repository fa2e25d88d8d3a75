"""Operator 6: toxic spans by a linear-chain conditional random field.

Labels are of documents. Words and word beginnings that go with toxic labels mark the tokens of toxic
training documents; the field learns these token labels from hashed features. Forward-backward marginals
give offending spans and, through a logistic curve over their sum and maximum, a document's score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T

FEATURES = 1 << 18
#: Tokens whose marginals are computed at once, and training texts that are read at once.
CHUNK, PART = 100_000, 128
#: Word beginnings of so many bytes are features beside the word itself.
STARTS = (4, 5, 6, 7)
#: Labelled texts of each class that the queries learn from.
SAMPLE = 2000
#: Bytes of the longest text that is learned from, and of all of them; half of these for each class.
LONGEST, MOST_BYTES = 1 << 18, 1 << 26
_SCORE = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])))])


@dataclass
class Field:
    """Weights of label 1 by feature, transition scores [before, after] and start scores; curve over document sums."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    curve: np.ndarray | None = None  # None: nothing was learned
    base: float = 0.0


def tokens(column: pa.Array):
    """(feature ids [token, feature], first byte, byte after, index of each text's first token) of texts."""
    raw, off = T.buffers(column)
    h, a, z, first = T.word_hashes(raw, off, letters_only=True)
    ids = np.empty((len(h), 1 + len(STARTS)), np.int32)
    ids[:, 0] = h >> np.uint64(46)
    low, n, code = T.lower(raw), z - a, np.zeros(len(h), np.uint64)
    for j in range(max(STARTS)):
        at = np.minimum(a + j, max(len(low) - 1, 0))
        code = code << np.uint64(8) | np.where(j < n, low[at], 0).astype(np.uint64) if len(low) else code
        if j + 1 in STARTS:
            ids[:, STARTS.index(j + 1) + 1] = T.fmix(code ^ T._SLOT[j % len(T._SLOT)]) >> np.uint64(46)
    return ids, a, z, first


def forward_backward(e: np.ndarray, begins: np.ndarray, model: Field, pairs: bool = False):
    """Marginals of label 1 (and expected transition counts) for all tokens of many documents at once.

    The documents are one chain whose matrix at a document's first token ignores what came before. The
    chain is cut into rows; rows' products give each row's entry vectors, then all rows advance together.
    """
    n = len(e)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    pad = rows * width - n
    x = np.exp(np.clip(np.concatenate([e, np.zeros(pad)]), -30, 30))
    s = np.concatenate([begins, np.ones(pad, bool)])
    t, b = np.exp(model.transitions), np.exp(model.start)
    grid = lambda v: np.ascontiguousarray(v.reshape(rows, width).T)  # noqa: E731  [step, row]
    m00, m10 = grid(np.where(s, b[0], t[0, 0])), grid(np.where(s, b[0], t[1, 0]))
    m01, m11 = grid(np.where(s, b[1], t[0, 1]) * x), grid(np.where(s, b[1], t[1, 1]) * x)
    p00, p01, p10, p11 = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for k in range(width):
        p00, p01, p10, p11 = p00 * m00[k] + p01 * m10[k], p00 * m01[k] + p01 * m11[k], p10 * m00[k] + p11 * m10[k], p10 * m01[k] + p11 * m11[k]
        scale = 1 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    fa, fb = np.empty((rows, 2)), np.ones((rows, 2))
    a = np.array([0.5, 0.5])
    for r in range(rows):
        fa[r] = a
        a = np.array([a[0] * p00[r] + a[1] * p10[r], a[0] * p01[r] + a[1] * p11[r]])
        a /= a.sum()
    for r in range(rows - 1, 0, -1):
        v = fb[r]
        w = np.array([p00[r] * v[0] + p01[r] * v[1], p10[r] * v[0] + p11[r] * v[1]])
        fb[r - 1] = w / w.sum()
    a0, a1 = fa[:, 0].copy(), fa[:, 1].copy()
    al = np.empty((width, rows, 2))
    for k in range(width):
        a0, a1 = a0 * m00[k] + a1 * m10[k], a0 * m01[k] + a1 * m11[k]
        scale = 1 / (a0 + a1)
        a0, a1 = a0 * scale, a1 * scale
        al[k, :, 0], al[k, :, 1] = a0, a1
    b0, b1 = fb[:, 0].copy(), fb[:, 1].copy()
    be = np.empty((width, rows, 2))
    for k in range(width - 1, -1, -1):
        be[k, :, 0], be[k, :, 1] = b0, b1
        b0, b1 = m00[k] * b0 + m01[k] * b1, m10[k] * b0 + m11[k] * b1
        scale = 1 / (b0 + b1)
        b0, b1 = b0 * scale, b1 * scale
    al, be = al.transpose(1, 0, 2).reshape(-1, 2)[:n], be.transpose(1, 0, 2).reshape(-1, 2)[:n]
    both = al * be
    p = both[:, 1] / both.sum(1)
    if not pairs:
        return p, None
    x = x[:n]
    xi = al[:-1, :, None] * (t[None] * np.stack([np.ones(n - 1), x[1:]], 1)[:, None, :]) * be[1:, None, :]
    xi = xi[~begins[1:]]
    return p, (xi / xi.sum((1, 2), keepdims=True)).sum(0) if len(xi) else np.zeros((2, 2))


def _begins(first: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n + 1, bool)
    out[first] = True
    return out[:n]


def _sums(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[log1p of the sum, maximum, 1] of marginals for each document."""
    total = np.concatenate([[0], np.cumsum(p)])
    size = np.diff(first)
    top = np.zeros(len(size))
    has = size > 0
    if has.any():
        top[has] = np.maximum.reduceat(p, first[:-1][has])
    return np.stack([np.log1p(np.maximum(total[first[1:]] - total[first[:-1]], 0)), top, np.ones(len(size))], 1)


def _emission(model: Field, ids: np.ndarray) -> np.ndarray:
    return model.weights[ids].sum(1, dtype=np.float64)


def _chunks(ids: np.ndarray, first: np.ndarray, model: Field, pairs: bool = False):
    """Yields (first token, token after, marginals, pair counts) of whole texts with some CHUNK tokens, so that memory does not grow with the texts."""
    i = 0
    while i < len(first) - 1:
        j = max(i + 1, int(np.searchsorted(first, first[i] + CHUNK, "right")) - 1)
        a, z = int(first[i]), int(first[j])
        if z > a:
            yield a, z, *forward_backward(_emission(model, ids[a:z]), _begins(first[i:j] - a, z - a), model, pairs)
        i = j


def _marginals(ids: np.ndarray, first: np.ndarray, model: Field) -> np.ndarray:
    return np.concatenate([np.zeros(0), *[p for _, _, p, _ in _chunks(ids, first, model)]])


def _learn(ids: np.ndarray, first: np.ndarray, toxic: np.ndarray, rounds: int, min_docs: int, min_share: float, odds: float, deviations: float) -> Field:
    """Weights from the tokens of labelled texts; the curve is left open."""
    model, n1, n0 = Field(), toxic.sum(), (~toxic).sum()
    in_docs = np.zeros((2, FEATURES))
    for d in range(len(toxic)):
        in_docs[int(toxic[d]), np.unique(ids[first[d] : first[d + 1]])] += 1
    chance = (in_docs[0] + 0.5) / max(n0, 1) * n1
    strong = (in_docs[1] >= max(min_docs, min_share * n1)) & (in_docs[1] > odds * chance) & (in_docs[1] > chance + deviations * np.sqrt(chance))
    y = (strong[ids].any(1) & np.repeat(toxic, np.diff(first))).astype(np.float64)
    begins = _begins(first, len(ids))
    yi, seen = y.astype(int), np.zeros((2, 2))
    np.add.at(seen, (yi[:-1][~begins[1:]], yi[1:][~begins[1:]]), 1)
    seen_start = np.bincount(yi[begins], minlength=2)
    w, gw, gt, gs = np.zeros(FEATURES), np.full(FEATURES, 1e-8), np.full((2, 2), 1e-8), np.full(2, 1e-8)
    for _ in range(rounds):  # AdaGrad on the whole likelihood, with a weak pull to zero
        model.weights = w.astype(np.float32)
        g, g_pairs, g_start = -0.05 * w, seen.copy(), seen_start.astype(np.float64)
        for i, j, p, xi in _chunks(ids, first, model, pairs=True):
            g += np.bincount(ids[i:j].ravel(), np.repeat(y[i:j] - p, ids.shape[1]), FEATURES)
            g_pairs -= xi
            at = p[begins[i:j]]
            g_start -= np.array([(1 - at).sum(), at.sum()])
        gw += g * g
        w += 0.8 * g / np.sqrt(gw)
        gt += g_pairs * g_pairs
        model.transitions = model.transitions + 0.5 * g_pairs / np.sqrt(gt)
        gs += g_start * g_start
        model.start = model.start + 0.5 * g_start / np.sqrt(gs)
    model.weights = w.astype(np.float32)
    return model


def _own_texts(texts: pa.Array) -> np.ndarray:
    """Which texts are not copies of an earlier one, as far as any of three min-hashes of their three-word shingles tells:
    a word that only one widely copied text has is no evidence."""
    seen, keep = set(), np.zeros(len(texts), bool)
    for at in range(0, len(texts), PART):
        h, _, _, first = T.word_hashes(*T.buffers(texts.slice(at, PART)), letters_only=True)
        for d, u in enumerate(T.shingles(h, first, 3)):
            marks = {(k, int(T.fmix(u ^ T._SLOT[k]).min())) for k in range(3)} if len(u) else {(-1, 0)}
            keep[at + d] = not marks & seen
            seen |= marks
    return keep


def fit(texts: pa.Array, toxic: np.ndarray, *, rounds: int = 20, min_docs: int = 4, min_share: float = 0.015, odds: float = 25.0, deviations: float = 10.0) -> Field:
    """Train on labelled texts. A token of a toxic text is labelled 1 if its word, or one of its beginnings,
    stands in ``min_docs`` toxic texts and ``min_share`` of them, ``odds`` times as often as in other texts, and in more than
    chance allows by ``deviations`` standard deviations. The curve from marginals to scores is fitted on texts that the field in use
    has not seen: each half is scored by a field from the other half. Copies of a text count once, unless less than ``min_docs`` texts
    of a class would be left: then all count."""
    base = float(toxic.mean()) if len(toxic) else 0.0
    if not len(toxic) or toxic.all() or not toxic.any():
        return Field(base=base)
    own = _own_texts(texts)
    if toxic[own].sum() >= min_docs and (~toxic[own]).sum() >= min_docs:
        texts, toxic = texts.filter(pa.array(own)), toxic[own]
    parts = [tokens(texts.slice(at, PART)) for at in range(0, len(texts), PART)]
    ids = np.concatenate([p[0] for p in parts])
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[3]) for p in parts]))])
    del parts
    if not len(ids):
        return Field(base=base)
    how = (rounds, min_docs, min_share, odds, deviations)
    half = np.where(toxic, np.cumsum(toxic), np.cumsum(~toxic)) % 2 == 0  # every other text of each class
    x = np.zeros((len(toxic), 3))
    size = np.diff(first)
    for own in (half, ~half):
        if toxic[own].all() or not toxic[own].any():
            continue
        at = lambda pick: (ids[np.repeat(pick, size)], np.concatenate([[0], np.cumsum(size[pick])]))
        part, begin = at(own)
        model = _learn(part, begin, toxic[own], *how) if len(part) else Field()
        part, begin = at(~own)
        x[~own] = _sums(_marginals(part, begin, model), begin)
    model, c = _learn(ids, first, toxic, *how), np.zeros(3)
    for _ in range(30):  # Newton steps for the curve
        q = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(3)
        c = c + np.linalg.solve(h, x.T @ (toxic - q) - 0.1 * c)
    model.curve, model.base = c, base
    return model


def _training_rows(docs: DataFrame, labels: DataFrame, sample: int, longest: int = LONGEST, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(text, __toxic) of at most ``sample`` labelled texts of each class, those of least hash, as long as they take no more than half of
    ``most_bytes``, in one partition and in order of class and hash; texts of more than ``longest`` bytes are not learned from. A document with several labels counts as toxic if one says so; null labels and
    ids are left out."""
    told = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("__toxic"))
    pick = lambda x: told.where(F.col("__toxic") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = F.broadcast(pick(True).unionByName(pick(False)))  # at most 2 * sample rows
    size = F.octet_length(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", "text").withColumn("__size", size).where(F.col("__size") <= longest).join(picked, "doc_id").dropDuplicates(["doc_id"])
    rows = materialize(rows, "toxicity-sample")
    so_far = F.sum("__size").over(Window.partitionBy("__toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))  # at most ``sample`` rows in a class
    rows = rows.withColumn("__so_far", so_far).where(F.col("__so_far") <= most_bytes // 2).coalesce(1)
    return rows.sortWithinPartitions("__toxic", F.xxhash64("doc_id"), "doc_id").select("text", "__toxic")


def _columns(rows: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels of training rows, as ``fit`` takes them."""
    column = rows.column("text").combine_chunks()
    column = column if isinstance(column, pa.Array) else column.chunk(0)
    return column.cast(pa.large_string()), np.asarray(rows.column("__toxic").to_pylist(), bool)


def training_texts(docs: DataFrame, labels: DataFrame, sample: int, **bounds) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels of ``_training_rows``, brought to the driver."""
    return _columns(_training_rows(docs, labels, sample, **bounds).toArrow())


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **bounds) -> Field:
    """The field that ``fit`` learns from ``_training_rows``. A task learns it, so that neither the texts nor their tokens
    take the driver's memory; the driver gets the weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            model = fit(*_columns(pa.Table.from_batches(held)))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    found = _training_rows(docs, labels, sample, **bounds).mapInArrow(run, "model binary").collect()  # one row of some 1 MB
    return pickle.loads(found[0]["model"]) if found else Field()


def score(docs: DataFrame, model: Field, span_probability: float = 0.5, with_spans: bool = True) -> DataFrame:
    """doc_id, score (0 to 1) and spans (start, end, probability: characters of tokens whose marginal reaches
    ``span_probability``) for each row of ``docs``. A null or empty text has the score of no evidence and no
    spans; without labels to learn from, the score is the share of toxic labels, or 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.slices(whole, "text"):
                ids, a, z, first = tokens(b.column("text"))
                if model.curve is None:
                    out = np.full(b.num_rows, model.base)
                    p = np.zeros(len(ids))
                else:
                    p = _marginals(ids, first, model)
                    out = 1 / (1 + np.exp(-np.clip(_sums(p, first) @ model.curve, -30, 30)))
                spans = [[] for _ in range(b.num_rows)]
                if with_spans:
                    raw, off = T.buffers(b.column("text"))
                    before = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])  # characters before each byte
                    for t in np.flatnonzero(p >= span_probability):
                        d = int(np.searchsorted(first, t, "right")) - 1
                        spans[d].append({"start": int(before[a[t]] - before[off[d]]), "end": int(before[z[t]] - before[off[d]]), "probability": float(p[t])})
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.float64()), pa.array(spans, _SCORE.field("spans").type)], schema=_SCORE)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(run, "doc_id long, score double, spans array<struct<start: long, end: long, probability: double>>")
    return out if with_spans else out.drop("spans")


def keep_clean(docs: DataFrame, model: Field, threshold: float) -> DataFrame:
    """Rows of ``docs`` whose score is below ``threshold``; all columns stay, each row is judged by its own text."""
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.slices(whole, "text"):
                if model.curve is None:
                    keep = np.full(b.num_rows, model.base < threshold)
                else:
                    ids, _, _, first = tokens(b.column(b.schema.get_field_index("text")))
                    p = _marginals(ids, first, model)
                    keep = 1 / (1 + np.exp(-np.clip(_sums(p, first) @ model.curve, -30, 30))) < threshold
                yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, fields)
