"""Operator 8: secret scanning with a random forest against false positives.

Candidates are long runs of token characters, and values that are assigned to a name. Their features are length, entropy, how usual
their character transitions are in the corpus, how much of them the corpus's own dictionary covers, whether they look like a
path, and the words and signs beside them. A Spark ML random forest, trained from labelled findings, tells secrets from the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rarity
from . import text as T

#: Shortest runs with and without a digit, and shortest assigned values.
MIN_LENGTH, MIN_LETTERS, MIN_VALUE = 16, 20, 1
#: A word of the dictionary has been seen about so often (code of the rarity table: 2 + 4 log2(8)).
_KNOWN = 14
NEIGHBOURS = 16
# Words that name a credential when a value is assigned to them.
CREDENTIAL_WORDS = "token|secret|password|passwd|pwd|api_key|apikey|access_key|auth"
FEATURES = ["length", "entropy", "digit_share", "upper_share", "hex", "digits_only", "switches", "switch_share", "transition", "rarest_transition", "coverage", "in_path", "quoted", *(f"before_{k}" for k in range(NEIGHBOURS)), *(f"after_{k}" for k in range(NEIGHBOURS))]
_SCHEMA = "doc_id long, start long, end long, before string, candidate string, x array<double>"
_VALUE = re.compile(rb"[:=][ \t]*[\"']?([^\s\"'`,;]{%d,})" % MIN_VALUE)
_NAME = re.compile(rb"[\w\x80-\xff.-]+[\"']?[ \t]*[:=][ \t]*[\"']?$")

_TOKEN = np.zeros(256, bool)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-":
    _TOKEN[_c] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_CLASS = np.zeros(256, np.int8)
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 1, 2, 3


def _bucket(word: bytes) -> int:
    return int(T.word_hashes(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[0][0] % NEIGHBOURS) if word.strip() else 0


def transitions(docs: DataFrame) -> np.ndarray:
    """log2 of the chance of each byte (columns) after another (rows) inside all texts; 256 by 256, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for whole in batches:
            for b in T.slices(whole, "text"):
                raw, off = T.buffers(b.column("text"))
                inside = np.ones(max(len(raw) - 1, 0), bool)
                inside[off[(off > 0) & (off < len(raw))] - 1] = False  # the last byte of a text has none after it
                total += np.bincount((raw[:-1].astype(np.uint16) << 8 | raw[1:])[inside], minlength=1 << 16)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["pair", "n"])

    found = docs.select("text").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()  # at most 65,536 rows
    n = np.zeros(1 << 16)
    for r in found:
        n[r["pair"]] = r["n"]
    n = n.reshape(256, 256) + 0.5
    return np.log2(n / n.sum(1, keepdims=True)).astype(np.float32)


def _describe(raw: np.ndarray, a: int, z: int, lo: int, hi: int, table: np.ndarray, usual: np.ndarray) -> list[float]:
    own = raw[a:z]
    n, kind = len(own), _CLASS[own]
    p = np.bincount(own, minlength=256) / n
    p = p[p > 0]
    switches = int((kind[1:] != kind[:-1]).sum())
    letters = np.where(_CLASS[own] >= 2, own, 32).astype(np.uint8)
    h, s, e, _ = T.word_hashes(letters, np.array([0, n]))
    covered = int((e - s)[(e - s >= 3) & (table[rarity.slot(h)] >= _KNOWN)].sum()) if len(h) else 0
    left, right = bytes(raw[max(lo, a - 96) : a]), bytes(raw[z : min(hi, z + 48)])
    # The neighbour before is the word ahead of the name that a value is assigned to: labels may come from the name itself.
    ahead = _NAME.sub(b"", left).split()
    after = right.lstrip(b"\"'.,;:!?*$%&#|) ").split()
    hexa = all(c in b"0123456789abcdefABCDEF" for c in bytes(own))
    path = b"/" in bytes(own) or left.endswith((b"/", b"\\", b".")) or right.startswith((b"/", b"\\", b"@"))
    step = usual[own[:-1], own[1:]]
    flat = [n, -(p * np.log2(p)).sum(), _DIGIT[own].mean(), (kind == 2).mean(), hexa, bool(_DIGIT[own].all()), switches, switches / max(1, n - 1), step.mean(), step.min(), covered / n, path, left.endswith((b'"', b"'"))]
    b4, af = _bucket(ahead[-1].lower() if ahead else b""), _bucket(after[0].lower() if after else b"")
    return [float(v) for v in flat] + [float(b4 == k) for k in range(NEIGHBOURS)] + [float(af == k) for k in range(NEIGHBOURS)]


def _spans(raw: np.ndarray, off: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """Bytes of all candidates of texts that each end with a line feed: assigned values, and long runs outside of them."""
    data, values = raw.tobytes(), []
    for at in np.flatnonzero((raw == 61) | (raw == 58)).tolist():
        m = _VALUE.match(data, at)
        if m and (not values or m.start(1) >= values[-1][1]) and data[max(0, at - 8) : at].rstrip(b" \t\"'")[-1:].strip(b"\n:=/"):
            values.append(m.span(1))
    inside = np.concatenate([[False], _TOKEN[raw], [False]])
    a, z = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    digits = np.concatenate([[0], np.cumsum(_DIGIT[raw])])
    keep = np.where(digits[z] > digits[a], z - a >= min_length, z - a >= MIN_LETTERS)
    a, z = a[keep], z[keep]
    if values:
        v = np.array(values)
        at = np.searchsorted(v[:, 1], a, "right")  # the first value that ends after the run begins
        hit = np.minimum(at, len(v) - 1)
        free = (at == len(v)) | (v[hit, 0] >= z)
        a, z = a[free], z[free]
    return sorted([*values, *zip(a.tolist(), z.tolist())])


def candidates(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, start, end (in characters), before (text up to 48 bytes ahead), candidate and features x of every candidate in the
    whole texts: runs of token characters of at least ``min_length`` with a digit or MIN_LETTERS without one, and values of at least
    MIN_VALUE characters up to white space, a quote, comma or semicolon after ``name =`` or ``name:``. A run in a value is
    part of it. Null and empty texts have none."""
    table, usual = rarity.broadcast_table(docs), docs.sparkSession.sparkContext.broadcast(transitions(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, steps = table.value.array(), usual.value
        for whole in batches:
            for b in T.slices(whole, "text"):
                raw, off = T.buffers(b.column("text"))
                rows: list[list] = [[], [], [], [], [], []]
                before = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])  # characters before each byte
                for s, e in _spans(raw, off, min_length):
                    d = int(np.searchsorted(off, s, "right")) - 1
                    left = bytes(raw[max(off[d], s - 48) : s]).decode("utf-8", "ignore")
                    row = (b.column("doc_id")[d].as_py(), int(before[s] - before[off[d]]), int(before[e] - before[off[d]]), left, bytes(raw[s:e]).decode("utf-8", "ignore"), _describe(raw, s, e, off[d], off[d + 1], codes, steps))
                    for x, v in zip(rows, row):
                        x.append(v)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds)], names=["doc_id", "start", "end", "before", "candidate", "x"])

    # A line feed after each text keeps runs of two texts apart.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).alias("text"))
    return rows.mapInArrow(run, _SCHEMA)


def assigned_findings(found: DataFrame, train: Column) -> DataFrame:
    """Findings labelled by how they are written: 1 if assigned to a credential's name, else 0. ``train`` picks
    the rows that may be learned from. Stands in for a reviewer's table (columns x and label); the name and whether there is an
    assignment are no features, so the forest cannot read the labels back."""
    named = F.col("before").rlike(rf"(?i)({CREDENTIAL_WORDS})\w*[\"']?\s*[:=]\s*[\"']?$")
    return found.where(train).select("doc_id", "start", "x", named.cast("double").alias("label"))


def train_forest(findings: DataFrame, *, trees: int = 20, depth: int = 6, sample: int = 20_000, seed: int = 11):
    """A random forest from labelled findings (x, label; others tell equal ones apart); about ``sample`` of each label at most, those of
    least hash, are learned from. None if labels of only one kind are there."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    times = {r["label"]: r["count"] for r in findings.where(F.col("label").isNotNull()).groupBy("label").count().collect()}  # a row for each label
    if not {0.0, 1.0} <= times.keys():
        return None
    chance = F.pmod(F.xxhash64(*[c for c in findings.columns if c != "label"]), F.lit(1 << 30)) / float(1 << 30)
    keep = F.when(F.col("label") == 1, chance < sample / times[1.0]).when(F.col("label") == 0, chance < sample / times[0.0])
    rows = findings.where(keep).select(array_to_vector("x").alias("features"), "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(rows)


def scan(found: DataFrame, forest, threshold: float = 0.5) -> DataFrame:
    """doc_id, start, end, score, is_secret of candidates. Without a forest every candidate scores 0.5 and is
    reported, as nothing speaks against it."""
    if forest is None:
        return found.select("doc_id", "start", "end", F.lit(0.5).alias("score"), F.lit(True).alias("is_secret"))
    from pyspark.ml.functions import array_to_vector, vector_to_array

    out = forest.transform(found.withColumn("features", array_to_vector("x")))
    p = F.round(vector_to_array("probability")[1], 6)
    return out.select("doc_id", "start", "end", p.alias("score"), (p >= threshold).alias("is_secret"))
