"""Vectorised word and shingle hashing over the bytes of Arrow string columns.

Words are maximal runs of bytes other than space and 0x09-0x0D; A-Z are lowered. All functions work
on whole texts; a null text is an empty one. Hashes are 64 bits wide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_P = np.uint64(0x9E3779B97F4A7C15)
_SLOT = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
#: Bytes of a long word that are hashed at once, and from which length a word is long.
BLOCK, LONG = 1 << 20, 256
_powers: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64)}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        x = np.full(max(n, BLOCK), base, np.uint64)
        x[0] = 1
        _powers[kind] = np.multiply.accumulate(x)
    return _powers[kind][:n]


def fmix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def lower(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lowered."""
    return raw | ((raw - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying its texts; nulls have length 0."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]] if len(off) else raw[:0], off - off[0]


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _long_hash(word: np.ndarray) -> np.uint64:
    """Hash of one long word, by a polynomial over its bytes."""
    h = np.uint64(0)
    for i in range(0, len(word), BLOCK):
        part = word[i : i + BLOCK].astype(np.uint64) + np.uint64(1)
        h = fmix(np.array([h + (part * _power("p", _P, len(part))).sum(dtype=np.uint64)]))[0]
    return h


def _word_hashes(low: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of words, eight bytes at a time; those of more than LONG bytes one by one."""
    pad = np.concatenate([low, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(pad) - 7,), "<u8", pad, 0, (1,))
    h = fmix((eight[starts] & _MASKS[np.minimum(size, 8)]) + size.astype(np.uint64) * _SLOT[4])
    left, k = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(left):
        h[left] = fmix(h[left] * _P + (eight[starts[left] + k] & _MASKS[np.minimum(size[left] - k, 8)]))
        k += 8
        left = left[size[left] > k]
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] ^= _long_hash(low[starts[i] : starts[i] + size[i]])
    return h


def word_hashes(raw: np.ndarray, offsets: np.ndarray, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts: (hashes, first byte, byte after, index of each text's first word, with one more)."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64)
    low = lower(raw)
    # Unsigned differences wrap around, so one comparison tells a range.
    if letters_only:
        inside = (low - np.uint8(97) < 26) | (low >= 128) | (low - np.uint8(48) < 10)
    else:
        inside = (low != 32) & (low - np.uint8(9) >= 5)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a text's border also ends a word
    joined = inside[1:] & inside[:-1] & ~edge[1:n]
    first = inside.copy()
    first[1:] &= ~joined
    last = inside
    last[:-1] &= ~joined
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = _word_hashes(low, starts, ends - starts)
    return out, starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int, weight: np.ndarray | None = None):
    """(hash, text, weight) of all shingles of ``k`` words, texts in order.

    A text with fewer than ``k`` words has its whole sequence as its only shingle, one without words
    has none. ``weight`` is a value for each word; a shingle has the least of its words.
    """
    n, size = len(words), np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    h = np.zeros(n, np.uint64)
    w = None if weight is None else weight.copy()
    for j in range(k):
        m = n - j
        if m <= 0:
            break
        inside = doc[:m] == doc[j:]
        h[:m] += np.where(inside, words[j:] * _SLOT[j], np.uint64(0))
        if j and w is not None:
            np.minimum(w[:m], weight[j:], out=w[:m], where=inside)
    left = first[doc + 1] - np.arange(n)  # words from here to the end of the text
    keep = (left >= k) | (np.arange(n) == first[doc])
    h = fmix(h + np.minimum(left, k).astype(np.uint64))
    return h[keep], doc[keep], None if w is None else w[keep]


def shingles(words: np.ndarray, first: np.ndarray, k: int):
    """Yields the sorted distinct shingle hashes of each text."""
    h, doc, _ = shingle_hashes(words, first, k)
    cut = np.searchsorted(doc, np.arange(len(first)))
    for a, b in zip(cut[:-1], cut[1:]):
        yield np.unique(h[a:b])


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Parts of a batch with about ``limit`` bytes of text each (one long text may have more)."""
    col = batch.column(batch.schema.get_field_index(column))
    size = np.asarray(pc.fill_null(pc.binary_length(col), 0), np.int64)
    total, i = np.concatenate([[0], np.cumsum(size)]), 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j
