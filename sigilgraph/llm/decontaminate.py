"""Operator 4: benchmark decontamination by SimHash windows.

A document is read in windows of as many words as a benchmark item has; one with fewer words is a single window. A window's 128-bit SimHash is built
from its five-word shingles, weighted by their rarity among items. Fingerprints are cut into BLOCKS
blocks; two fingerprints within RADIUS bits differ in at most RADIUS // BLOCKS bits of one block at least, so looking up each block and
its neighbours in that distance finds all of them.
Found pairs are kept if their exact weighted Jaccard similarity reaches the threshold.

Windows that cannot reach the threshold with any item, as the weight of their shingles that stand in some item of
their size is below that share of their own weight, get no fingerprint; they would fail the exact test.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

SHINGLE, BITS, RADIUS, BLOCKS = 5, 128, 31, 16
_STEP = BITS // BLOCKS  # bits of a block
#: What a block may be xored with: all values of at most RADIUS // BLOCKS bits.
_NEAR = [x for x in range(1 << _STEP) if x.bit_count() <= RADIUS // BLOCKS]
_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())])


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of a shingle's two 64-bit hashes."""
    two = np.stack([hashes, T.fmix(hashes + T._SLOT[3])], -1)
    return np.unpackbits(two.astype("<u8").view(np.uint8).reshape(*hashes.shape, 16), axis=-1).astype(np.float32) * 2 - 1


def _runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    n = len(words) - k + 1
    if n <= 0:
        return words[:0]
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h += words[j : j + n] * T._SLOT[j]
    return T.fmix(h + np.uint64(k))


@dataclass
class Items:
    """Benchmark items ready for search."""

    ids: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    counts: list[dict] = field(default_factory=list)  # shingle hash -> times
    mass: list[float] = field(default_factory=list)
    prints: np.ndarray | None = None  # [item, block]
    whole: list[int] = field(default_factory=list)  # each fingerprint as one number
    at_size: np.ndarray | None = None  # for each known shingle where its sizes begin in sizes_of, with one more
    sizes_of: np.ndarray | None = None  # sizes of the items that hold each known shingle
    known: np.ndarray | None = None  # sorted shingle hashes of all items
    common: np.ndarray | None = None  # sorted hashes of the shingles that several items of the whole benchmark hold
    weights: np.ndarray | None = None  # of the common ones; all others weigh as much as unseen ones
    unseen: float = 1.0
    short: dict[int, dict] = field(default_factory=dict)  # words of an item -> hash of its run -> items

    def weigh(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weights, which are known) of shingles."""
        return _look_up(self.common, self.weights, hashes, self.unseen), _look_up(self.known, np.ones(len(self.known), bool), hashes, False)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default) -> np.ndarray:
    """The value of each wanted key in sorted ``keys``, or the default."""
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def fingerprint(total: np.ndarray) -> np.ndarray:
    """Blocks of the fingerprint of summed signs (rows)."""
    bits = (total > 0).reshape(len(total), BITS // _STEP, _STEP)
    return (bits * (1 << np.arange(_STEP))).sum(-1).astype(np.int64)


def as_number(blocks: np.ndarray) -> int:
    return int.from_bytes(blocks.astype(np.uint8).tobytes(), "little")


def _words(text: str | None) -> np.ndarray:
    return T.word_hashes(*T.buffers(pa.array([text or ""])), letters_only=True)[0]


def shingle_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(sorted hashes, items that hold each, number of items) of the shingles that several of all items hold; items with
    no id or fewer words than a shingle do not count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column("text").to_pylist():
                s = np.unique(_runs(_words(text), SHINGLE)).view(np.int64)
                if len(s):  # the null counts the item
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(s), pa.nulls(1, pa.int64())])], names=["shingle"])

    each = rows.where(F.col("item_id").isNotNull()).select("text").mapInArrow(run, "shingle long")
    found = each.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("shingle").isNull() | (F.col("n") > 1)).toArrow()
    h, n = found.column("shingle").combine_chunks(), np.asarray(found.column("n"))
    real = np.asarray(h.is_valid())
    hashes = np.asarray(h.drop_null()).astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], n[real][order], int(n[~real].sum())


def prepare(rows: list[tuple[int, str | None]], counts: tuple[np.ndarray, np.ndarray, int] | None = None) -> Items:
    """Items of one block; ``counts`` are the whole benchmark's, if the rows are only part of it."""
    out = Items()
    words_of = []
    for i, text in rows:
        h = _words(text)
        if i is None or not len(h):
            continue
        if len(h) < SHINGLE:
            out.short.setdefault(len(h), {}).setdefault(int(_runs(h, len(h))[0]), []).append(i)
        else:
            words_of.append((i, h))
    shingles = [_runs(h, SHINGLE) for _, h in words_of]
    seen = np.concatenate([np.unique(s) for s in shingles]) if shingles else np.zeros(0, np.uint64)
    out.known, df = np.unique(seen, return_counts=True)
    out.common, df, count = (out.known[df > 1], df[df > 1], len(words_of)) if counts is None else counts
    out.unseen = 1 + float(np.log(max(1, count)))
    out.weights = out.unseen - np.log(df)
    totals = []
    for (i, h), s in zip(words_of, shingles):
        u, n = np.unique(s, return_counts=True)
        w = out.weigh(u)[0]
        out.ids.append(i), out.sizes.append(len(h)), out.counts.append(dict(zip(u.tolist(), n.tolist())))
        out.mass.append(float((w * n).sum()))
        totals.append((_signs(u) * (w * n)[:, None]).sum(0))
    out.prints = fingerprint(np.array(totals)) if totals else np.zeros((0, BITS // _STEP), np.int64)
    out.whole = [as_number(x) for x in out.prints]
    pairs = [np.stack([np.searchsorted(out.known, np.unique(s)), np.full(len(np.unique(s)), len(h))], 1) for (_, h), s in zip(words_of, shingles)]
    both = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    out.at_size, out.sizes_of = np.searchsorted(both[:, 0], np.arange(len(out.known) + 1)), both[:, 1]
    return out


def _search(words: np.ndarray, items: Items, tables: list[dict], bit_of: np.ndarray, threshold: float) -> dict[int, tuple[float, int, int]]:
    """item id -> (similarity, first word, words) of its best window in one document."""
    best: dict[int, tuple[float, int, int]] = {}
    for size, table in items.short.items():
        runs = _runs(words, size)
        for r in np.flatnonzero(np.isin(runs, np.array(list(table), np.uint64))):
            for i in table[int(runs[r])]:
                best.setdefault(i, (1.0, int(r), size))
    s = _runs(words, SHINGLE)
    if not len(s) or not bit_of[(s >> np.uint64(44)).astype(np.int64)].any():
        return best
    w, hit = items.weigh(s)
    if not hit.any():
        return best
    all_ = np.concatenate([[0], np.cumsum(w)])
    where = np.flatnonzero(hit)
    which = np.searchsorted(items.known, s[where])
    times = items.at_size[which + 1] - items.at_size[which]
    # A row for each place of a known shingle and each size of an item that holds it.
    place = np.repeat(where, times)
    sizes = items.sizes_of[np.repeat(items.at_size[which] - np.cumsum(times) + times, times) + np.arange(times.sum())]
    for size in np.unique(sizes).tolist():
        k = min(size - SHINGLE + 1, len(s))  # a document with fewer words than the item is one window
        own_places = place[sizes == size]
        known = np.concatenate([[0], np.cumsum(np.bincount(own_places, w[own_places], len(s)))])
        at = np.flatnonzero(known[k:] - known[:-k] >= threshold * (all_[k:] - all_[:-k]) - 1e-9)
        for a in at:
            own = s[a : a + k]
            u, n = np.unique(own, return_counts=True)
            wu = items.weigh(u)[0]
            blocks = fingerprint((_signs(u) * (wu * n)[:, None]).sum(0)[None])[0]
            near = {j for t, b in zip(tables, blocks.tolist()) for x in _NEAR for j in t.get((size, b ^ x), ())}
            own_print = as_number(blocks) if near else 0
            for j in near:
                if (own_print ^ items.whole[j]).bit_count() > RADIUS:
                    continue
                shared = sum(x * min(c, items.counts[j].get(h, 0)) for h, c, x in zip(u.tolist(), n.tolist(), wu))
                value = shared / (float((wu * n).sum()) + items.mass[j] - shared)
                if value >= threshold - 1e-9 and value > best.get(items.ids[j], (0,))[0]:
                    best[items.ids[j]] = (value, int(a), k + SHINGLE - 1)
    return best


def find(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, item_block: int = 20_000) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: for each row of ``docs`` and each item, the best
    window that reaches ``threshold`` (the earliest of equals).

    Words are runs of letters and digits, A-Z lowered. Items go to the tasks in blocks of about
    ``item_block``, one pass over the documents each; every block weighs shingles by their counts over all items. An item of fewer than five words is one shingle, its whole
    sequence; empty and null items match nothing, and null or empty texts match nothing. Rows with a null
    doc_id are searched and reported with it; an item_id that is null is left out.
    """
    spark = docs.sparkSession
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-rows.count() // item_block))
    counts = shingle_counts(rows) if blocks > 1 else None
    found = []
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        items = prepare([(r["item_id"], r["text"]) for r in part.collect()], counts)  # about item_block rows
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            tables: list[dict] = [{} for _ in range(BLOCKS)]
            for j in range(len(items.ids)):
                for b in range(BLOCKS):
                    tables[b].setdefault((items.sizes[j], int(items.prints[j, b])), []).append(j)
            bit_of = np.zeros(1 << 20, bool)
            bit_of[(items.known >> np.uint64(44)).astype(np.int64)] = True
            for whole in batches:
                for b in T.slices(whole, "text"):
                    h, _, _, first = T.word_hashes(*T.buffers(b.column("text")), letters_only=True)
                    out = []
                    for d, doc in enumerate(b.column("doc_id").to_pylist()):
                        for i, (v, a, n) in _search(h[first[d] : first[d + 1]], items, tables, bit_of, threshold).items():
                            out.append({"doc_id": doc, "item_id": i, "similarity": v, "first_word": a, "n_words": n})
                    yield pa.RecordBatch.from_pylist(out, schema=_HITS)

        found.append(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, item_id long, similarity double, first_word long, n_words long"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8) -> DataFrame:
    """Rows of ``docs`` in which no item is found; all columns stay. Rows are decided by doc_id (a null one is
    kept unless some row with a null id holds an item)."""
    leaked = find(docs, benchmark, threshold=threshold).select(F.col("doc_id").alias("__leaked")).distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(F.col("__leaked")), "left_anti")
