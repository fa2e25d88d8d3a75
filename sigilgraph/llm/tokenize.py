"""Token ids of whole texts by a public tokenizer, a column of texts at once.

Byte-pair encoding works on one pre-token at a time, so the ids of a text are those of its pre-tokens. A column is cut
into pre-tokens over its bytes; those of up to 16 bytes are looked up by their own bytes (not by a hash of them) in
a table of what they encode to, and the tokenizer's BPE model runs on those that a worker has not met. Texts with
characters for which this cutting might differ from the tokenizer's are encoded by the tokenizer as a whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from . import text as T

#: Slots of a worker's table of pre-tokens; it is emptied when half of them are taken. Takes some 60 MB.
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
#: Pre-tokens looked up at once; fewer than half of the slots.
PIECES = 1 << 17
#: Long pre-tokens kept beside the table.
LONG_ENTRIES = 20_000
_encoders: dict[str, "Encoder"] = {}
LETTER, NUMBER, SPACE, OTHER, ODD = range(5)

# The public pre-token patterns of the two kinds of tokenizers, as their files write them.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_END = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that byte-level BPE writes for each byte: itself if printable, else the next free one from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


def _kinds(lower: bool) -> np.ndarray:
    """Kind of each character below U+10000; ODD if lower case, normal forms, or what libraries hold to be white space may matter."""
    import unicodedata

    import regex

    all_ = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(1 << 16))
    out = np.full(1 << 16, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s"), (ODD, r"[\p{Cn}\p{Cs}\p{M}]" if lower else r"[\p{Cn}\p{Cs}]")):
        out[[m.start() for m in regex.finditer(pattern, all_)]] = kind
    # Libraries know different versions of Unicode: what is new to this Python may be unassigned to the tokenizer.
    out[[c for c in range(1 << 16) if unicodedata.category(chr(c)) == "Cn"]] = ODD
    out[0] = ODD
    out[0x1C:0x20] = ODD
    beyond = np.arange(1 << 16) >= 128
    out[beyond & (out == SPACE)] = ODD
    out[0x180E] = ODD
    if lower:  # known to be safe: Latin letters that only ASCII and Latin-1 rules lower, and general punctuation
        out[0x250:0x2010] = ODD
        out[0x2028:] = ODD
        for c in range(0x100, 0x250):
            if chr(c).lower() != chr(c):
                out[c] = ODD
        for c in [*range(128, 0x250), *range(0x2010, 0x2028)]:
            if unicodedata.normalize("NFC", chr(c)) != chr(c):
                out[c] = ODD
    return out


class Encoder:
    """``ids(text)`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids``. Raises ValueError for a tokenizer
    whose pre-tokens or normal forms are not of the two kinds known here."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.lower = self._is_lower(told)
        self.letters = byte_letters()
        self.kinds = _kinds(self.lower)
        special = [regex.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(special).encode()).finditer if special else None
        self._clear()

    @staticmethod
    def _is_lower(told: dict) -> bool:
        """False for the byte-level kind, True for the lower-case one with word ends."""
        cut, form = told.get("pre_tokenizer") or {}, told.get("normalizer")
        if cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and form is None:
            return False
        parts = cut.get("pretokenizers") or [{}]
        forms = [x.get("type") for x in (form or {}).get("normalizers", [])]
        if parts[0].get("type") == "Split" and (parts[0].get("pattern") or {}).get("Regex") == WORD_END and parts[0].get("invert") and forms == ["NFC", "Replace", "Lowercase"]:
            return True
        raise ValueError("a tokenizer of another kind: its pre-tokens or normal forms are not known here")

    def _clear(self) -> None:
        self.used = 0
        self.key = np.zeros((2, SLOTS), np.uint64)
        self.at, self.n = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.pool = np.zeros(1 << 21, np.uint32)
        self.filled = 0
        self.long: dict[bytes, np.ndarray] = {}

    def _piece(self, piece: bytes) -> list[int]:
        letters = self.letters
        return [t.id for t in self.model.tokenize("".join([letters[b] for b in piece]))]

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text that is not cut over its bytes."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _starts(self, raw: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(kind of each byte, where segments begin, positions of odd bytes); a segment is a pre-token or, for the lower-case kind, white space."""
        kind = self.kinds[raw]
        high = np.flatnonzero(raw >= 0xC0)
        if len(high):
            pad = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.int32)
            lead = pad[high]
            two, three = lead < 0xE0, (lead >= 0xE0) & (lead < 0xF0)
            code = np.where(two, (lead & 31) << 6 | pad[high + 1] & 63, (lead & 15) << 12 | (pad[high + 1] & 63) << 6 | pad[high + 2] & 63)
            own = np.where(two | three, self.kinds[np.where(two | three, code, 0)], ODD)
            kind[high], kind[high + 1] = own, own
            kind[high[three] + 2] = own[three]
            if not (two | three).all():
                kind[high[~two & ~three] + 2] = ODD
        n = len(raw)
        start = edge.copy()
        start[1:] |= kind[1:] != kind[:-1]
        space = kind == SPACE
        if self.lower:
            start |= (kind == NUMBER) & (raw & 0xC0 != 0x80)
        else:  # the last white space before a word: a blank goes with the word, others stand alone
            after = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:]) + 1
            start[after - 1] = True
            start[after[raw[after - 1] == 32]] = False
        mark = np.flatnonzero((raw == 39) & start)
        mark = mark[mark + 1 < n]
        mark = mark[(kind[mark + 1] == LETTER) & ~edge[mark + 1]]
        if len(mark):
            a, b = raw[mark + 1], raw[np.minimum(mark + 2, n - 1)]
            one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
            two = ((a == 114) & (b == 101) | (a == 118) & (b == 101) | (a == 108) & (b == 108)) & (mark + 2 < n) & ~edge[np.minimum(mark + 2, n - 1)]
            for at, size in ((mark[one], 2), (mark[two], 3)):
                start[at + 1] = False
                end = at + size
                start[end[end < n]] = True
        return kind, start, np.flatnonzero(kind == ODD)

    def _known(self, k0: np.ndarray, k1: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 if it is not in the table."""
        out = np.full(len(k0), -1, np.int32)
        at = (T.fmix(k0 ^ T.fmix(k1 + T._P)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        left = np.arange(len(k0))
        while len(left):
            same = (self.key[0][at] == k0[left]) & (self.key[1][at] == k1[left])
            out[left[same]] = at[same]
            go = ~same & (self.n[at] > 0)
            left, at = left[go], (at[go] + 1) & (SLOTS - 1)
        return out

    def _insert(self, k0: np.ndarray, k1: np.ndarray, ids: list[list[int]]) -> None:
        """New keys, each once."""
        size = np.array([len(x) for x in ids], np.int32)
        flat = np.array([i for x in ids for i in x], np.uint32)
        if self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.filled], np.zeros(max(len(self.pool), 2 * len(flat)), np.uint32)])
        self.pool[self.filled : self.filled + len(flat)] = flat
        begin = (self.filled + np.cumsum(size) - size).astype(np.int32)
        self.filled += len(flat)
        self.used += len(k0)
        at = (T.fmix(k0 ^ T.fmix(k1 + T._P)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        left = np.arange(len(k0))
        while len(left):
            _, first = np.unique(at, return_index=True)
            take = np.zeros(len(at), bool)
            take[first] = self.n[at[first]] == 0
            i, s = left[take], at[take]
            self.key[0][s], self.key[1][s], self.at[s], self.n[s] = k0[i], k1[i], begin[i], size[i]
            left, at = left[~take], (at[~take] + 1) & (SLOTS - 1)

    def column(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each begins, with one more); null texts are empty. ``end_id`` is
        appended to each text if given."""
        raw, off = T.buffers(texts)
        many, n = len(off) - 1, len(raw)
        extra = 0 if end_id is None else 1
        odd_texts = np.zeros(many, bool)
        if n:
            if self.lower:
                raw = T.lower(raw)
                lift = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)  # Latin-1 capitals
                raw[1:][lift] += 0x20
            edge = np.zeros(n + 1, bool)
            edge[off] = True
            edge = edge[:n]
            kind, start, odd = self._starts(raw, edge)
            odd_texts[np.searchsorted(off, odd, "right") - 1] = True
            data = raw.tobytes()
            if self.special is not None:
                for m in self.special(data):
                    odd_texts[np.searchsorted(off, m.start(), "right") - 1] = True
            a = np.flatnonzero(start)
            z = np.append(a[1:], n)
            doc = np.searchsorted(off, a, "right") - 1
            keep = ~odd_texts[doc]
            if self.lower:
                keep &= kind[a] != SPACE
            if not keep.all():
                a, z, doc = a[keep], z[keep], doc[keep]
            found = [self._look_up(raw, data, a[i : i + PIECES], z[i : i + PIECES]) for i in range(0, len(a), PIECES)]
        else:
            doc, found = np.zeros(0, np.int64), []
        size = np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found]])
        ids = np.concatenate([np.zeros(0, np.uint32), *[f[1] for f in found]])
        own = np.bincount(doc, size, many).astype(np.int64)
        total, whole = own.copy(), {}
        for d in np.flatnonzero(odd_texts).tolist():
            whole[d] = self._whole(texts[d].as_py())
            total[d] = len(whole[d])
        begin = np.concatenate([[0], np.cumsum(total + extra)])
        out = np.empty(int(begin[-1]), np.uint32)
        shift = begin[:-1] - (np.cumsum(own) - own)
        out[np.arange(len(ids)) + np.repeat(shift, own)] = ids
        for d, x in whole.items():
            out[begin[d] : begin[d] + len(x)] = x
        if extra:
            out[begin[1:] - 1] = end_id
        return out, begin

    def _look_up(self, raw: np.ndarray, data: bytes, a: np.ndarray, z: np.ndarray):
        """(number of ids of each pre-token raw[a:z], the ids of all)."""
        size = z - a
        pad = np.concatenate([raw, np.zeros(16, np.uint8)])
        eight = np.ndarray((len(pad) - 7,), "<u8", pad, 0, (1,))
        masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        k0 = eight[a] & masks[np.minimum(size, 8)]
        k1 = np.zeros(len(a), np.uint64)
        wide = np.flatnonzero(size > 8)
        k1[wide] = eight[a[wide] + 8] & masks[np.minimum(size[wide] - 8, 8)]
        short = size <= 16
        slot = self._known(k0, k1)
        slot[~short] = -1
        new = np.flatnonzero((slot < 0) & short)
        if len(new):
            order = new[np.lexsort((k1[new], k0[new]))]
            first = np.ones(len(order), bool)
            first[1:] = (k0[order[1:]] != k0[order[:-1]]) | (k1[order[1:]] != k1[order[:-1]])
            once = order[first]
            if self.used + len(once) > SLOTS // 2:
                self._clear()
                new = np.flatnonzero(short)  # entries in use may be gone
                order = new[np.lexsort((k1[new], k0[new]))]
                first = np.ones(len(order), bool)
                first[1:] = (k0[order[1:]] != k0[order[:-1]]) | (k1[order[1:]] != k1[order[:-1]])
                once = order[first]
            self._insert(k0[once], k1[once], [self._piece(data[i:j]) for i, j in zip(a[once].tolist(), z[once].tolist())])
            slot[new] = self._known(k0[new], k1[new])
        at, n, pool = self.at[slot].astype(np.int64), self.n[slot].astype(np.int64), self.pool
        long_ = np.flatnonzero(~short)
        if len(long_):
            parts, filled = [pool[: self.filled]], self.filled
            for k in long_.tolist():
                piece = data[a[k] : z[k]]
                ids = self.long.get(piece)
                if ids is None:
                    ids = np.array(self._piece(piece), np.uint32)
                    if len(piece) <= 256:
                        if len(self.long) >= LONG_ENTRIES:
                            self.long.clear()
                        self.long[piece] = ids
                at[k], n[k] = filled, len(ids)
                parts.append(ids)
                filled += len(ids)
            pool = np.concatenate(parts)
        return n, pool[np.repeat(at - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]

    def ids(self, text: str) -> np.ndarray:
        return self.column(pa.array([text], pa.large_string()))[0]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(path: str, batch: pa.RecordBatch, end_id: int, limit: int = 1 << 20):
    """Yields (part of the batch, ids, begins) for parts of about ``limit`` bytes of its column ``text``."""
    for part in T.slices(batch, "text", limit):
        yield part, *encoder(path).column(part.column(part.schema.get_field_index("text")), end_id)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
