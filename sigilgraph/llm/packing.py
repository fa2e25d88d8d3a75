"""Operator 9: packing documents into sequences along a space-filling curve.

Token ids are hashed into a vector, the vector is projected to a few dimensions, and its place on the
Hilbert curve of those dimensions is the sort key. Range partitions of the key are packed as streams, so
neighbouring sequences hold documents with similar words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tokenize import encoded

FEATURES, DIMS, BITS = 1024, 4, 8
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (rows) with ``bits`` bits in each dimension, by Skilling's
    transposition: undo excess work from the highest bit down, Gray-encode, then interleave."""
    x = points.astype(np.uint32).T.copy()
    n, q = len(x), np.uint32(1 << (bits - 1))
    while q > 1:
        p = q - np.uint32(1)
        for i in range(n):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] ^= np.where(on, p, swap).astype(np.uint32)
            x[i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), np.uint32(1 << (bits - 1))
    while q > 1:
        t ^= np.where((x[n - 1] & q) > 0, q - np.uint32(1), 0).astype(np.uint32)
        q >>= np.uint32(1)
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> np.uint32(b)) & 1)
    return key


def curve_keys(docs_ids: list[np.ndarray], features: int = FEATURES, dims: int = DIMS) -> np.ndarray:
    """Keys of documents: square roots of hashed id counts, scaled to length 1, projected by fixed
    random signs and cut into 2**BITS steps between -4 and 4 standard deviations."""
    signs = np.random.default_rng(7).choice([-1.0, 1.0], (features, dims))
    v = np.zeros((len(docs_ids), features), np.float64)
    for i, ids in enumerate(docs_ids):
        v[i] = np.sqrt(np.bincount((ids * np.uint32(2654435761)) >> np.uint32(22), minlength=features)[:features])
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    steps = np.clip((v @ signs + 4) * ((1 << BITS) / 8), 0, (1 << BITS) - 1)
    return hilbert_key(steps)


def pack(docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, max_tokens: int = 4096, partitions: int | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, on
    request, ids (little-endian unsigned 32-bit).

    Each row of ``docs`` is a document (null text: only ``end_id``; repeated and null ids are kept). A
    sequence is filled to ``max_tokens``, documents being cut where it ends. The last tokens of a
    partition make sequences of falling powers of two, which need no padding; so at most
    log2(max_tokens) sequences of a partition are short and none is padded.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, flat, at in encoded(tokenizer_path, whole, end_id):
                ids = [flat[i:j] for i, j in zip(at[:-1], at[1:])]
                keys = [curve_keys(ids[i : i + 256]) for i in range(0, len(ids), 256)]
                cols = [batch.column("doc_id"), pa.array(np.concatenate(keys)), pa.array(np.diff(at), pa.int64()), pa.array([x.astype("<u4" if x.max() > 65535 else "<u2").tobytes() for x in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "key", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    coded = materialize(rows.mapInArrow(tokens, "doc_id long, key long, n long, ids binary"), "pack")
    tie = [F.col("doc_id"), F.crc32("ids")]
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = coded.repartitionByRange(n, "key", *tie).sortWithinPartitions("key", *tie)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seq = TaskContext.get().partitionId() << 40
        out: list[dict] = []
        held: list[tuple] = []  # (doc_id, start, ids, doc_tokens) that fill the open sequence
        room = max_tokens

        def place(pieces, number):
            at = 0
            for d, s, x, n_doc in pieces:
                raw = x.astype("<u4").tobytes()
                out.append({"doc_id": d, "start": s, "length": len(x), "ids_crc32": zlib.crc32(raw), "doc_tokens": n_doc, "sequence_id": number, "offset": at, "ids": raw if with_ids else None})
                at += len(x)

        for batch in batches:
            for d, size, raw in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), batch.column("ids")):
                raw = raw.as_py()
                ids, at = np.frombuffer(raw, "<u2" if len(raw) == 2 * size else "<u4"), 0
                while at < size:
                    take = min(room, size - at)
                    held.append((d, at, ids[at : at + take], size))
                    at, room = at + take, room - take
                    if not room:
                        place(held, seq)
                        held, room, seq = [], max_tokens, seq + 1
                if len(out) >= 2048:
                    yield pa.RecordBatch.from_pylist(out, schema=_PIECES)
                    out.clear()
        left = max_tokens - room
        while left:  # falling powers of two
            size = 1 << (left.bit_length() - 1)
            part, need = [], size
            while need:
                d, s, x, n_doc = held.pop(0)
                part.append((d, s, x[:need], n_doc))
                if len(x) > need:
                    held.insert(0, (d, s + need, x[need:], n_doc))
                need -= min(need, len(x))
            place(part, seq)
            seq, left = seq + 1, left - size
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_PIECES)

    pieces = ranged.mapInArrow(fill, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
    return pieces if with_ids else pieces.drop("ids")
