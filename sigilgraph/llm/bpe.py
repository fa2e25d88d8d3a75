"""Operator 11: byte-level byte-pair encoding of whole texts, and decoding.

A pre-token's bytes start as a doubly linked list of symbols. All neighbouring pairs that a merge rule names wait in a priority
queue of (rank, place). The least is taken, and skipped as stale if its place no longer holds that pair; else the two symbols become
one, the right one leaves the list, and the pairs with the new neighbours are queued. That is n log n steps for n bytes, however long
a pre-token is. Rules and vocabulary are read from the tokenizer's file; the library's own merging takes no part.

Pre-tokens are cut and remembered as for operator 1 (tokenize.py). A text with characters for which that cutting might differ is cut
at special tokens and by the tokenizer's pre-tokenizer, and merged here all the same. Decoding joins the byte strings of the ids.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .tokenize import Encoder, byte_letters

#: Bytes of text, and number of ids, that a task works on at once (one longer text may have more).
TEXT_BYTES, IDS = 1 << 20, 1 << 20
_codecs: dict[str, "Codec"] = {}


class Codec(Encoder):
    """``column(texts)`` and ``decode(ids)`` equal the library's encode and decode, without truncation, padding and added special
    tokens. Raises ValueError for a tokenizer whose vocabulary lacks a byte or whose merging has other rules."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, vocab = told["model"], told["model"]["vocab"]
        if self.lower or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")):
            raise ValueError("a tokenizer with other rules than byte-level merging")
        if missing := [b for b, letter in enumerate(self.letters) if letter not in vocab]:
            raise ValueError(f"no token for the bytes {missing}")
        self.width = max(vocab.values()) + 1
        self.first = [vocab[letter] for letter in self.letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {vocab[a] * self.width + vocab[b]: k for k, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.added = {x.content: i for i, x in self.tokenizer.get_added_tokens_decoder().items()}
        self.strings = self._byte_strings(vocab)
        self.size = np.array([len(s) for s in self.strings], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(self.strings), np.uint8)

    def _byte_strings(self, vocab: dict[str, int]) -> list[bytes]:
        """The bytes of each id: of its letters, or of the token itself if it has another character; none for a free id."""
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        out = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for token, i in [*vocab.items(), *self.added.items()]:
            out[i] = bytes([byte[c] for c in token]) if all(c in byte for c in token) else token.encode()
        return out

    def _piece(self, piece: bytes) -> list[int]:
        symbol = [self.first[b] for b in piece]
        n, rank_of, width = len(symbol), self.rank.get, self.width
        if n == 1:
            return symbol
        # An entry is one number: the rank above 40 bits of place.
        queue = [r << 40 | i for i in range(n - 1) if (r := rank_of(symbol[i] * width + symbol[i + 1])) is not None]
        if not queue:
            return symbol
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heapq.heappop(queue)
            rank, i = entry >> 40, entry & 0xFFFFFFFFFF
            j = after[i]
            if symbol[i] < 0 or j == n or rank_of(symbol[i] * width + symbol[j]) != rank:
                continue  # stale
            new = symbol[i] = self.made[rank]
            symbol[j] = -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if (r := rank_of(new * width + symbol[j])) is not None:
                    heapq.heappush(queue, r << 40 | i)
            h = before[i]
            if h >= 0 and (r := rank_of(symbol[h] * width + new)) is not None:
                heapq.heappush(queue, r << 40 | h)
        return [s for s in symbol if s >= 0]

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text that is not cut over its bytes."""
        data, out, at = text.encode(), [], 0
        ends = [(m.start(), m.end()) for m in self.special(data)] if self.special else []
        byte = {letter: b for b, letter in enumerate(self.letters)}
        for a, z in [*ends, (len(data), len(data))]:
            for letters, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(data[at:a].decode()) if a > at else []:
                out += self._piece(bytes([byte[c] for c in letters]))
            if z > a:
                out.append(self.added[data[a:z].decode()])
            at = z
        return np.array(out, np.uint32)

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, where each begins) of ids ids[begin[k]:begin[k + 1]]; unknown ids have no bytes."""
        known = ids < len(self.size)
        which = np.where(known, ids, 0)
        size = np.where(known, self.size[which], 0)
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.begin[which] - total[:-1], size) + np.arange(int(total[-1]))
        return self.bytes[at], total[begin]


def codec(path: str) -> Codec:
    """The worker's codec for a tokenizer file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens long, ids binary: little-endian unsigned 32-bit) of every whole text of ``docs`` (doc_id, text; others are
    ignored). A null text is an empty one, without ids. Each row gives one, repeated and null doc_ids as well. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text", TEXT_BYTES):
                ids, begin = codec(tokenizer_path).column(part.column("text"))
                raw, at = ids.astype("<u4").tobytes(), (begin * 4).tolist()
                blobs = pa.array([raw[a:z] for a, z in zip(at[:-1], at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(begin), pa.int64()), blobs], names=["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """``rows`` (doc_id, n_tokens, ids as of ``encode``) with ``decoded``, the text that the ids stand for. Bytes that are no UTF-8,
    as of ids that were cut inside a character, become U+FFFD. Null ids give an empty text; special tokens are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "ids", 4 * IDS):
                blobs = [x or b"" for x in part.column("ids").to_pylist()]
                begin = np.concatenate([[0], np.cumsum([len(x) // 4 for x in blobs])])
                raw, at = codec(tokenizer_path).decode(np.frombuffer(b"".join(blobs), "<u4"), begin)
                raw, at = raw.tobytes(), at.tolist()
                texts = pa.array([raw[a:z].decode("utf-8", "replace") for a, z in zip(at[:-1], at[1:])], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "n_tokens", "ids")), texts], names=["doc_id", "n_tokens", "ids", "decoded"])

    return rows.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows of ``decode``."""
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
