"""How rare words are, counted over all documents in a table of fixed size.

A word's 64-bit hash picks one of 2**24 counters; the counters are summed over the whole corpus and kept as
one byte each on a logarithmic scale. The table always takes 16 MB, so it may be broadcast; the driver holds it
compressed (packed.py). It orders tokens by rarity for prefix filters: any order that all tasks share gives
right joins, collisions only make a word look more common. A counter of one proves that its word occurs once in the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .packed import Packed, pack

SLOTS, PARTS = 1 << 24, 64
_PART = SLOTS // PARTS


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64)


def rarity_table(docs: DataFrame, letters_only: bool = False) -> Packed:
    """uint8 codes by slot: 0 unseen, 1 seen once, then 2 + 4 log2(count), for the words of all texts."""
    import zstandard

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.uint32)
        for whole in batches:
            for b in T.slices(whole, "text"):
                at, n = np.unique(slot(T.word_hashes(*T.buffers(b.column(0)), letters_only)[0]), return_counts=True)
                total[at] += n.astype(np.uint32)
        zip_, parts, blobs = zstandard.ZstdCompressor(level=1), [], []
        for p in range(PARTS):
            own = total[p * _PART : (p + 1) * _PART]
            at = np.flatnonzero(own)
            if len(at):
                parts.append(p)
                blobs.append(len(at).to_bytes(8, "little") + zip_.compress(np.concatenate([np.diff(at, prepend=0), own[at]]).astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, sums = zstandard.ZstdDecompressor(), {}
        for b in batches:
            for p, blob in zip(b.column("part").to_pylist(), b.column("counts").to_pylist()):
                n = int.from_bytes(blob[:8], "little")
                x = np.frombuffer(unzip.decompress(blob[8:]), "<u4")
                own = sums.setdefault(p, np.zeros(_PART, np.int64))
                own[np.cumsum(x[:n])] += x[n:]
        code = [np.where(s <= 1, s, np.minimum(255, 2 + np.floor(4 * np.log2(np.maximum(s, 1))))).astype(np.uint8) for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([pack(c) for c in code], pa.binary())], names=["part", "codes"])

    partial = docs.select("text").mapInArrow(count, "part int, counts binary").repartition(PARTS, "part")
    return Packed.collect(partial.mapInArrow(add, "part int, codes binary"), SLOTS, _PART)  # at most PARTS rows, 16 MB in all before packing


def broadcast_table(docs: DataFrame, letters_only: bool = False):
    """The table as a broadcast variable; an element is read as ``b.value.array()[slot(hash)]``."""
    return docs.sparkSession.sparkContext.broadcast(rarity_table(docs, letters_only))
