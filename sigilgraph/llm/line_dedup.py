"""Operator 7: line dedup by an exact set-similarity join.

A line is the set of its words; lines without words, and with fewer than ``min_tokens`` different ones, are left alone. A line is removed if
an earlier line of the corpus (by doc_id, then place in the document) has a Jaccard similarity of ``percent`` / 100 or
more with it, whether or not that one is removed as well, so the result does not depend on any order of work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import rarity, setjoin
from . import text as T

_SEEN = 500_000
_LINE = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("line", pa.int32()), ("node", pa.int64()), ("n", pa.int32()), ("keys", pa.list_(pa.int64())), ("b0", pa.int64()), ("b1", pa.int64())])


def _lines(b: pa.RecordBatch, min_tokens: int):
    """(sets of all lines with words, text index, line number, which have enough words) of a batch; None without any."""
    raw, off = T.buffers(b.column("text"))
    h, a, _, first = T.word_hashes(raw, off)
    if not len(h):
        return None
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    line = breaks[a]  # line feeds before each word, over the whole batch
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    new = np.zeros(len(h), bool)
    new[1:] = (np.diff(line) != 0) | (np.diff(doc) != 0)
    unit = np.cumsum(new)
    heads = np.flatnonzero(np.concatenate([[True], new[1:]]))
    sets = setjoin.Units(h, unit, len(heads))
    return sets, doc[heads], line[heads] - breaks[off[doc[heads]]], sets.n >= min_tokens


def _first_seen(nodes: np.ndarray, wanted: np.ndarray, seen: set) -> np.ndarray:
    """Which wanted nodes the task has not met before."""
    out = np.zeros(len(nodes), bool)
    at = np.flatnonzero(wanted)
    for k, node in zip(at.tolist(), nodes[at].tolist()):
        if node not in seen:
            if len(seen) >= _SEEN:
                seen.clear()
            seen.add(node)
            out[k] = True
    return out


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, rid (a hash of the text) and text. Rows equal in both are one document, a null id comes first."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc_id"), F.xxhash64("text").alias("rid"), "text")


def line_units(docs: DataFrame, percent: int, min_tokens: int, table) -> DataFrame:
    """(doc_id, rid, line, node, n, keys, b0, b1) of lines with enough words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, seen = table.value.array(), set()
        for whole in batches:
            for b in T.slices(whole, "text"):
                found = _lines(b, min_tokens)
                if found is None:
                    continue
                sets, doc, line, ok = found
                nodes = sets.nodes()
                # Sets of so few words that one word more or less is too much link with equal ones alone, which are one node.
                post = _first_seen(nodes, ok & (100 * sets.n >= percent * (sets.n + 1)), seen)
                keys = sets.short_lists(codes[rarity.slot(sets.hashes)], percent, post)
                at = pa.array(np.flatnonzero(ok))
                cols = [b.column("doc_id").take(pa.array(doc)), b.column("rid").take(pa.array(doc)), pa.array(line.astype(np.int32)), pa.array(nodes), pa.array(sets.n.astype(np.int32)), keys, *map(pa.array, sets.bitmaps())]
                yield pa.RecordBatch.from_arrays([c.take(at) for c in cols], schema=_LINE)

    return _documents(docs).mapInArrow(run, "doc_id long, rid long, line int, node long, n int, keys array<long>, b0 long, b1 long")


def line_sets(docs: DataFrame, min_tokens: int, bits) -> DataFrame:
    """(node, hashes) of lines that the filter wants."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set = set()
        for whole in batches:
            for b in T.slices(whole, "text"):
                found = _lines(b, min_tokens)
                if found is None:
                    continue
                sets, _, _, ok = found
                nodes = sets.nodes()
                at = np.flatnonzero(_first_seen(nodes, ok & setjoin.wanted(bits.value, nodes), done))
                blobs = [sets.sorted_hashes(k).astype("<u8").tobytes() for k in at]
                yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(blobs, pa.binary())], names=["node", "hashes"])

    return docs.select("text").mapInArrow(run, "node long, hashes binary")


def removed_lines(docs: DataFrame, *, percent: int = 80, min_tokens: int = 1, longer: int = setjoin.LONG, cell: int = setjoin.CELL) -> DataFrame:
    """doc_id, rid, lines: numbers (from 0) of each document's removed lines, for documents that lose some. A null
    doc_id is the least long and comes first; null, empty and one-line texts are documents like others; rows equal in
    doc_id and text count once."""
    spark = docs.sparkSession
    table = rarity.broadcast_table(docs)
    rows = materialize(line_units(docs, percent, min_tokens, table), "line-units")
    posts = setjoin.postings(rows)
    found = materialize(setjoin.candidate_pairs(posts, percent, longer=longer), "line-lists")
    pairs = materialize(setjoin.merge_lists(found, percent), "line-pairs")
    cut = found.where(F.col("c").isNull() & (F.col("nc") == 1)).select("q", "c")  # lists whose parts have not met
    bits = spark.sparkContext.broadcast(setjoin.node_filter(pairs.select("q", "c").unionByName(cut)))
    sets = materialize(line_sets(docs, min_tokens, bits), "line-sets")
    links = setjoin.verified(pairs, sets, percent)
    place = F.struct("doc_id", "rid", "line")
    first = materialize(rows.groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("times")), "line-first")

    def later(links: DataFrame) -> DataFrame:
        """The nodes of links that come first later than the other."""
        both = links.join(first.select(F.col("node").alias("a"), F.col("first").alias("fa")), "a").join(first.select(F.col("node").alias("b"), F.col("first").alias("fb")), "b")
        return both.select(F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("node")).distinct()

    late = materialize(later(links), "line-late")
    if found.where(F.col("c").isNull()).limit(1).count():
        done = pairs.select("q", "c")
        for few in (2, None):  # the earliest lines of a list settle most others, so few are left for the full look
            state = first.join(late.withColumn("s", F.lit(1)), "node", "left").select("node", "s", F.col("first.doc_id").alias("o"))
            more = setjoin.left_over(found, state, percent, few, components=False, cell=cell)
            more = materialize(more.join(done, ["q", "c"], "left_anti"), "line-rest")
            if more.limit(1).count():
                late = materialize(late.unionByName(later(setjoin.verified(more, sets, percent))).distinct(), "line-late")
            done = done.unionByName(more.select("q", "c"))
    marked = first.join(late.withColumn("late", F.lit(True)), "node", "left").where(F.col("late") | (F.col("times") > 1)).select("node", "first", F.coalesce("late", F.lit(False)).alias("late"))
    gone = rows.select("doc_id", "rid", "line", "node").join(marked, "node").where(F.col("late") | (place != F.col("first")))
    return gone.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def counts(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers) for each row of ``docs``; a null text has no lines."""
    gone = removed_lines(docs, **how)
    base = _documents(docs).select("doc_id", "rid", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    out = base.join(gone, ["doc_id", "rid"], "left")
    real = F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id"))
    return out.select(real.alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("lines", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with removed lines taken out of text (and n_chars, if there, counted anew); all rows and columns stay."""
    gone = removed_lines(docs, **how).select(F.col("doc_id").alias("__id"), F.col("rid").alias("__rid"), F.col("lines").alias("__lines"))
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63)).cast("long"))
    out = docs.join(gone, (key == F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__rid")), "left")
    left = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(F.col("__lines"), i)), "\n")
    text = F.when(F.col("__lines").isNull(), F.col("text")).otherwise(left)
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__lines").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
