"""Operator 3: language identification by nearest centroid.

Byte n-grams (one to three bytes) are hashed into a vector, weighted by TF-IDF and scaled to length 1. Each
language has several centroids from spherical k-means; the closest by cosine names the language. A text
farther from its centroid than nearly all of that centroid's own training texts is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

DIMS = 4096
UNKNOWN = "und"


@dataclass
class Centroids:
    languages: list[str]  # of each centroid
    matrix: np.ndarray  # [centroid, dimension], rows of length 1
    idf: np.ndarray
    radius: np.ndarray  # greatest cosine distance accepted by each centroid


def counts(column: pa.Array) -> np.ndarray:
    """Hashed n-gram counts [text, dimension] of whole texts: letters in lower case (ASCII and Latin-1), with one
    space for all that stands between words."""
    raw, off = T.buffers(column)
    low = T.lower(raw)
    if len(low) > 1:  # U+00C0-U+00DE are 0xC3 0x80-0x9E in UTF-8, their lower case is 0x20 higher
        capital = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
        low[1:][capital] += 0x20
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    first = np.zeros(len(low) + 1, bool)
    first[off] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~first[1 : len(low)]  # the first sign after a word stands for the gap
    x = np.where(letter, low, 32)[keep].astype(np.uint32)
    off = np.concatenate([[0], np.cumsum(keep)])[off]
    out = np.zeros((len(off) - 1, DIMS), np.float32)
    mix = lambda v: ((v * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)  # noqa: E731  12 bits
    one = mix(x + np.uint32(1))
    two = mix((x[:-1] << np.uint32(8) | x[1:]) + np.uint32(0x10000)) if len(x) > 1 else one[:0]
    three = mix((x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) + np.uint32(0x2000000)) if len(x) > 2 else one[:0]
    for d in range(len(off) - 1):
        a, z = int(off[d]), int(off[d + 1])
        for grams, n in ((one, 1), (two, 2), (three, 3)):
            if z - a >= n:
                out[d] += np.bincount(grams[a : z - n + 1], minlength=DIMS)
    return out


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def _kmeans(v: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, started from the mean and then the farthest vectors."""
    c = [v.mean(0)]
    for _ in range(min(k, len(v)) - 1):
        c.append(v[(v @ np.array(c).T).max(1).argmin()])
    c = np.array(c)
    for _ in range(rounds):
        own = (v @ c.T).argmax(1)
        c = np.array([v[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c, (v @ c.T).argmax(1)


def fit(docs: DataFrame, *, sample_docs: int = 3000, clusters: int = 4, least_docs: int = 8, quantile: float = 0.995, slack: float = 1.25) -> Centroids | None:
    """Learn from ``docs`` (text, lang, doc_id): about ``sample_docs`` rows in all, the same number for each
    language but ``least_docs`` at least, chosen by a hash of doc_id. Rows without language or text are
    left out; None if there is nothing to learn from."""
    docs = docs.where(F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = docs.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language
    if not found:
        return None
    share = max(sample_docs / len(found), least_docs)
    keep = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, share / r["n"]))])
    chance = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.slices(whole, "text"):
                tf = [x.astype("<f4").tobytes() for x in counts(b.column("text"))]
                yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(tf, pa.binary())], names=["lang", "tf"])

    rows = docs.where(chance < keep[F.col("lang")]).select("lang", "text").mapInArrow(features, "lang string, tf binary").toArrow()
    if not rows.num_rows:
        return None
    tf = np.frombuffer(b"".join(rows.column("tf").to_pylist()), "<f4").reshape(-1, DIMS)
    langs = np.array(rows.column("lang").to_pylist())
    idf = (np.log((1 + len(tf)) / (1 + (tf > 0).sum(0))) + 1).astype(np.float32)
    v, names, cents, radius = vectors(tf, idf), [], [], []
    for lang in sorted(set(langs)):
        own = v[langs == lang]
        c, near = _kmeans(own, clusters)
        for j in range(len(c)):
            d = 1 - own[near == j] @ c[j]
            names.append(lang), cents.append(c[j]), radius.append(min(1.0, slack * float(np.quantile(d, quantile))) if len(d) else 0.0)
    return Centroids(names, np.array(cents, np.float32), idf, np.array(radius))


def predict(docs: DataFrame, model: Centroids | None, *, reject: bool = True) -> DataFrame:
    """doc_id, lang_pred, score (cosine to the closest centroid, 0 to 1), rejected.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned. With ``reject``, a text
    outside its centroid's radius is ``und`` as well. Ties go to the language that sorts first. Each row is
    scored by its text alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.slices(whole, "text"):
                has = np.asarray(b.column("letter").to_pylist(), bool)
                lang, value, out = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows), np.zeros(b.num_rows, bool)
                for i in range(0, b.num_rows if model is not None else 0, 512):
                    part = slice(i, i + 512)
                    sims = vectors(counts(b.column("text").slice(i, 512)), model.idf) @ model.matrix.T
                    best = sims.argmax(1)
                    value[part] = np.clip(sims[np.arange(len(best)), best], 0, 1)
                    out[part] = 1 - value[part] > model.radius[best]
                    lang[part] = np.array(model.languages, object)[best]
                lang[~has] = UNKNOWN
                value[~has], out[~has] = 0, False
                if reject:
                    lang[out] = UNKNOWN
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(value), pa.array(out)], names=["doc_id", "lang_pred", "score", "rejected"])

    letter: Column = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", letter.alias("letter")).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
