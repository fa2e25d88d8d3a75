"""Exact Jaccard joins of hashed sets, shared by operators 2 and 7.

A *set* is a text unit's distinct 64-bit token hashes; its *node* is a 64-bit fingerprint of the whole set, so
equal sets are one node. Tokens are ordered by rarity (rarity.py), ties by hash. Two sets of sizes a and b with
100 * overlap >= percent * union share at least T = ceil(percent (a + b) / (100 + percent)) tokens. A set of n tokens
needs ceil(percent n / 100) common ones with any partner, so two linked sets have their first m common tokens among the
first n - ceil(percent n / 100) + m tokens of each (``occurrences`` m; fewer if the set needs fewer). Only these are posted.
A token that the rarity table has seen once is in no other set and is not posted, but keeps its position.

Candidates come from inverted lists. Each posting carries its set's size, the token's position and a parity bitmap: a
bit is the parity of the tokens that hash to it, so two bitmaps differ in no more bits than the sets in tokens. Pairs of a
list pass a length, a positional and the bitmap filter before they leave their task.

Lists that many sets share are settled step by step, so that neither a task nor the output holds all pairs of a group:

1. A list longer than ``LONG`` is cut into parts by node hash (how long lists are is estimated from an eighth of all nodes, which
   decides on nothing but the cut). Inside a list or part that gives more than MANY pairs a node, each node
   is paired with its FIRST partners in the order of node hashes alone, which is the same in all lists of a group.
2. ``left_over`` looks at these lists again, without pairs that are settled by then. Each node outside the list's settled bulk is held
   against all of the list, in cells of some ``CELL`` by ``CELL`` postings that are dealt out one by one: first against a few, then all.
   A parity bitmap of 128 bits is full for sets of a few hundred tokens, so that all pairs of a family that does not link would leave
   the cells, each out of every list it shares: ``sketches`` give the cells 512 bits, and few such pairs leave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T
from .packed import Packed, pack

#: A list may give so many pairs for each of its nodes; else each node is paired with FIRST others.
MANY, FIRST = 4, 2
#: Postings from which a list is cut, and that a side of a cell has on average (up to 16 times as many in very long lists).
LONG, CELL = 1024, 256
#: Postings that are compared at once, and bound of their pairs (a longer list is one block).
BLOCK, PAIRS = 100_000, 1 << 22
#: Rows of at most 32 bytes, one for each of some lists, up to which they are broadcast.
SMALL = 500_000
#: Bits of the filter that tells which nodes' sets are wanted; 16 MB, whatever the input.
FILTER_BITS = 1 << 27
PAIR = "q long, nq int, c long, nc int"
#: A posting: k is 48 bits of its list and then its set's size, at most 65535, so one number sorts both; size is n << 32 | position.
POSTING = ["k", "node", "size", "b0", "b1"]
#: A sketch: the words of a signature of 512 bits, or of 256 and then zeros (sets of fewer than WIDE tokens).
SKETCH, WIDE = [f"g{k}" for k in range(8)], 256


def need(a, b, percent: int):
    """Least overlap of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


class Units:
    """The sets of many text units at once, from token hashes and the unit (ascending) of each."""

    def __init__(self, hashes: np.ndarray, unit: np.ndarray, count: int):
        order = np.argsort(unit.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
        h, u = hashes[order], unit[order]
        near = (h[1:] >> np.uint64(24) == h[:-1] >> np.uint64(24)) & (u[1:] == u[:-1])
        if (near & (h[1:] != h[:-1])).any():  # hashes equal in the bits that were sorted by: sort by all
            order = np.lexsort((hashes, unit))
            h, u = hashes[order], unit[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (u[1:] != u[:-1])
        self.order = order[new]  # index of a token of each distinct hash
        self.hashes, self.unit = h[new], u[new]
        self.n = np.bincount(self.unit, minlength=count)
        self.start = np.concatenate([[0], np.cumsum(self.n)])

    def _reduce(self, values: np.ndarray, how) -> np.ndarray:
        """A ufunc's reduction over each unit, 0 for empty ones."""
        out = np.zeros(len(self.n), np.uint64)
        has = self.n > 0
        if has.any():
            out[has] = how.reduceat(values, self.start[:-1][has])
        return out

    def nodes(self) -> np.ndarray:
        """Fingerprints: order-free mixes of the sets' hashes."""
        return T.fmix(self._reduce(T.fmix(self.hashes + T._SLOT[0]), np.add) + self.n.astype(np.uint64) * T._P).view(np.int64)

    def bitmaps(self) -> tuple[np.ndarray, np.ndarray]:
        """The two halves of each unit's parity bitmap."""
        bit = self.hashes >> np.uint64(20)
        one = np.uint64(1) << (bit & np.uint64(63))
        second = (bit >> np.uint64(6)) & np.uint64(1) == 1
        return tuple(self._reduce(np.where(second == k, one, np.uint64(0)), np.bitwise_xor).view(np.int64) for k in (False, True))

    def signature(self, unit: int) -> bytes:
        """A parity bitmap with about a bit for each token (a power of two, 256 at least)."""
        own = self.hashes[self.start[unit] : self.start[unit + 1]]
        width = max(256, 1 << int(len(own)).bit_length())
        odd = np.bincount((own >> np.uint64(8)).astype(np.int64) & (width - 1), minlength=width) & 1
        return np.packbits(odd.astype(bool), bitorder="little").tobytes()

    def short_lists(self, codes: np.ndarray, percent: int, wanted: np.ndarray, occurrences: int = 1) -> pa.Array:
        """A list column: the ``k`` of each wanted unit's posted tokens in order, null for tokens that no other set has, and
        NULL for other units. codes: rarity of each distinct token."""
        key = self.unit.astype(np.uint64) << np.uint64(40) | codes.astype(np.uint64) << np.uint64(32) | self.hashes >> np.uint64(32)
        order = np.argsort(key, kind="stable")
        unit = self.unit[order]
        pos = np.arange(len(order)) - self.start[unit]
        least = -(-percent * self.n // 100)
        length = np.where(wanted, self.n - least + np.minimum(occurrences, least), 0)
        keep = pos < length[unit]
        order, unit = order[keep], unit[keep]
        k = (self.hashes[order] & ~np.uint64(65535)) | np.minimum(self.n[unit], 65535).astype(np.uint64)
        values = pa.array(k.view(np.int64), mask=codes[order] == 1)
        off = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(off), values, mask=pa.array(~wanted))

    def sorted_hashes(self, unit: int) -> np.ndarray:
        return np.sort(self.hashes[self.start[unit] : self.start[unit + 1]])


def postings(units: DataFrame) -> DataFrame:
    """Postings (POSTING) of units (node, n, keys, b0, b1); keys may be null where the node was posted before."""
    each = units.where(F.size("keys") > 0).select("node", F.shiftleft(F.col("n").cast("long"), 32).alias("n"), "b0", "b1", F.posexplode("keys").alias("pos", "k"))
    return each.where(F.col("k").isNotNull()).select("k", "node", (F.col("n") + F.col("pos")).alias("size"), "b0", "b1")


def _list_id(c: str = "k"):
    return F.shiftright(c, 16)


def _with_size(list_id):
    """k of a list made up of ``list_id`` and the set's size."""
    return list_id.bitwiseAND(~65535).bitwiseOR(F.col("k").bitwiseAND(65535))


def _apart(sketch, n, i, j) -> np.ndarray:
    """In how many bits sketches of sets i and j differ, by the narrower's width."""
    bits = lambda words, x, y: sum(np.bitwise_count((w[x] ^ w[y]).view(np.uint64)).astype(np.int64) for w in words)
    wide = (n[i] >= WIDE) & (n[j] >= WIDE)
    out = np.zeros(len(i), np.int64)
    out[wide] = bits(sketch, i[wide], j[wide])
    out[~wide] = bits([a ^ b for a, b in zip(sketch[:4], sketch[4:])], i[~wide], j[~wide])
    return out


def _pairs(ids, node, n, pos, bits, percent: int, slack: int, open_=None, sketch=()):
    """Indices (i, j) of postings sorted by (ids, n) whose sets may link, for all lists of a block at once; node[i] < node[j].
    ``slack`` is how many common tokens a pair may have before this one. ``open_(i, j)`` tells which pairs are wanted."""
    found = []
    i = np.arange(len(ids) - 1)
    step = 0
    while len(i):
        step += 1
        i = i[i + step < len(ids)]
        # Sets that follow are larger still, so the length filter ends a posting's turn.
        i = i[(ids[i] == ids[i + step]) & (100 * n[i] >= percent * n[i + step])]
        j = i + step
        a, b = n[i], n[j]
        ok = node[i] != node[j]
        least = -(-percent * (a + b) // (100 + percent))
        ok &= np.minimum(a - pos[i], b - pos[j]) + slack >= least
        if open_ is not None:
            ok &= open_(i, j)
        x, y = i[ok], j[ok]
        if len(x):
            apart = sum(np.bitwise_count((b[x] ^ b[y]).view(np.uint64)).astype(np.int64) for b in bits)
            most = n[x] + n[y] - 2 * least[ok]
            x, y, most = (v[apart <= most] for v in (x, y, most))
            if sketch and len(x):
                ok = _apart(sketch, n, x, y) <= most
                x, y = x[ok], y[ok]
            if len(x):
                found.append((x, y))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z
    x, y = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    turn = node[x] > node[y]
    return np.where(turn, y, x), np.where(turn, x, y)


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]):
    """Whole lists of a stream sorted by its first column, ``k``, as columns (list ids first) of at most some BLOCK rows and PAIRS pairs."""
    held: list[list[np.ndarray]] = []

    def parts(cols: list[np.ndarray]):
        ids = cols[0] >> 16
        if (cols[0] & 65535 == 65535).any():  # sizes beyond what k holds
            order = np.lexsort((cols[names.index("size")] >> 32, ids))
            cols, ids = [c[order] for c in cols], ids[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])
        total = np.concatenate([[0], np.cumsum(np.diff(cuts) ** 2)])
        i = 0
        while i < len(cuts) - 1:
            j = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS, "right")) - 1)
            yield [ids[cuts[i] : cuts[j]], *(c[cuts[i] : cuts[j]] for c in cols[1:])]
            i = j

    def joined() -> list[np.ndarray]:
        return [np.concatenate([h[k] for h in held]) for k in range(len(names))]

    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append([np.array(b.column(name)) for name in names])
        size += b.num_rows
        if size >= BLOCK:
            all_ = joined()
            ids = all_[0] >> 16
            cut = int(np.searchsorted(ids, ids[-1]))  # the last list may go on
            if cut:
                yield from parts([c[:cut] for c in all_])
            held, size = [[c[cut:] for c in all_]], len(all_[0]) - cut
            if size >= BLOCK:
                size = 0  # one long list: look again after as many rows more
    if held:
        yield from parts(joined())


def _once(ids, node, *columns) -> list[np.ndarray]:
    """Rows of a block with each node once in a list: every task that meets a set posts it. Rows are sorted by list and the set's size,
    so that only runs of equal ones can hold a node again."""
    n = columns[0] >> 32
    near = np.concatenate([[False], (ids[1:] == ids[:-1]) & (n[1:] == n[:-1])])
    if not near.any():
        return [ids, node, *columns]
    run = np.flatnonzero(near | np.append(near[1:], False))
    o = run[np.lexsort((node[run], ids[run]))]
    again = np.zeros(len(ids), bool)
    again[o[1:]] = (ids[o][1:] == ids[o][:-1]) & (node[o][1:] == node[o][:-1])
    return [c[~again] for c in (ids, node, *columns)] if again.any() else [ids, node, *columns]


def _first(i: np.ndarray, j: np.ndarray, order: np.ndarray, few: int) -> np.ndarray:
    """Which pairs are among the first ``few`` of their j, by the order of i."""
    o = np.lexsort((order[i], j))
    start = np.flatnonzero(np.concatenate([[True], j[o][1:] != j[o][:-1]]))
    out = np.zeros(len(j), bool)
    out[o] = np.arange(len(j)) - np.repeat(start, np.diff(np.append(start, len(j)))) < few
    return out


def long_lists(posts: DataFrame, longer: int) -> DataFrame:
    """(list, parts) of lists that have about ``longer`` postings or more, estimated from an eighth of all nodes."""
    part = posts.where(F.pmod("node", F.lit(8)) == 0).groupBy(_list_id().alias("list")).agg(F.count("*").alias("n"))
    return part.where(F.col("n") >= max(2, longer * 3 // 32)).select("list", F.ceil(F.col("n") * 8 / F.lit(longer)).cast("int").alias("parts"))


def candidate_pairs(posts: DataFrame, percent: int, occurrences: int = 1, longer: int = LONG) -> DataFrame:
    """(q, nq, c, nc, enough, home, size, b0, b1): pairs out of the inverted lists; ``enough`` where the list was crowded, so that its
    other pairs and thus a pair's occurrences are not all there. And without c, for each list that left pairs out, its postings
    (node as q; ``home`` is the list), with nc = 1 if the list had been cut."""
    names = [*POSTING, "home"]
    out_names = ["q", "nq", "c", "nc", "enough", "home", "size", "b0", "b1"]
    slack = occurrences - 1

    def rows(n, **cols):
        kinds = {"nq": pa.int32(), "nc": pa.int32(), "enough": pa.bool_()}
        return pa.RecordBatch.from_arrays([pa.array(cols[c], kinds.get(c, pa.int64())) if c in cols else pa.nulls(n, kinds.get(c, pa.int64())) for c in out_names], names=out_names)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, names):
            ids, node, size, b0, b1, home = _once(*block)
            n, pos = size >> 32, size & 0xFFFFFFFF
            i, j = _pairs(ids, node, n, pos, (b0, b1), percent, slack)
            list_of = np.concatenate([[0], np.cumsum(ids[1:] != ids[:-1])])
            lists = list_of[-1] + 1
            many = np.bincount(list_of[i], minlength=lists) > MANY * np.bincount(list_of)
            cut = home != ids
            if len(i):
                keep = _first(i, j, node, FIRST) | ~many[list_of[j]]
                keep[np.unique(i, return_index=True)[1]] = True  # so that pairs name all nodes that any pair has
                i, j = i[keep], j[keep]
                enough = many[list_of[i]]
                for at in range(0, len(i), 1 << 16):
                    x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    yield rows(len(x), q=node[x], nq=n[x], c=node[y], nc=n[y], enough=enough[at : at + (1 << 16)])
            held = np.flatnonzero(many[list_of] | cut)
            for at in range(0, len(held), 1 << 16):
                x = held[at : at + (1 << 16)]
                yield rows(len(x), q=node[x], nq=n[x], nc=cut[x].astype(np.int32), home=home[x], size=size[x], b0=b0[x], b1=b1[x])

    heavy = _shared(long_lists(posts, longer))
    homed = posts.withColumn("home", _list_id()).join(heavy, F.col("home") == F.col("list"), "left")
    part = F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("parts")))
    dealt = homed.select(F.when(F.col("parts").isNull(), F.col("k")).otherwise(_with_size(part)).alias("k"), "node", "size", "b0", "b1", "home")
    dealt = dealt.repartition(_list_id()).sortWithinPartitions("k")
    return dealt.mapInArrow(lists, f"{PAIR}, enough boolean, home long, size long, b0 long, b1 long")


def merge_lists(found: DataFrame, percent: int, occurrences: int = 1) -> DataFrame:
    """T-occurrence over the short lists: distinct (q, nq, c, nc). Each candidate's occurrences on a query's short lists are
    counted; it must have ``occurrences`` (or all that the smaller set asks for), or come from a crowded list."""
    pairs = found.where(F.col("c").isNotNull())
    least = F.least(F.lit(occurrences), F.ceil(F.least("nq", "nc") * percent / 100))
    counted = pairs.groupBy("q", "nq", "c", "nc").agg(F.count("*").alias("occurrences"), F.max("enough").alias("enough"))
    return counted.where(F.col("enough") | (F.col("occurrences") >= least)).drop("occurrences", "enough")


def node_filter(pairs: DataFrame) -> Packed:
    """Bits of nodes that occur in pairs (q, c; c may be null), for ``wanted``."""

    step = FILTER_BITS // 8 // 32

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for b in batches:
            for name in ("q", "c"):
                _set(bits, np.asarray(b.column(name).drop_null()))
        rows = [(k, pack(bits[k * step : (k + 1) * step])) for k in range(32)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unzip, sums = zstandard.ZstdDecompressor(), {}
        for b in batches:
            for k, blob in zip(b.column("part").to_pylist(), b.column("bits").to_pylist()):
                x = np.frombuffer(unzip.decompress(blob), np.uint8)
                sums[k] = sums[k] | x if k in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([pack(x) for x in sums.values()], pa.binary())], names=["part", "bits"])

    parts = pairs.select("q", "c").mapInArrow(mark, "part int, bits binary").repartition(32, "part").mapInArrow(merge, "part int, bits binary")
    return Packed.collect(parts, FILTER_BITS // 8, step)  # at most 32 rows, 16 MB in all before packing


def _at(nodes: np.ndarray) -> np.ndarray:
    return (T.fmix(nodes.astype(np.int64).view(np.uint64)) >> np.uint64(37)).astype(np.int64)


def _set(bits: np.ndarray, nodes: np.ndarray) -> None:
    at = _at(nodes)
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))


def wanted(filter_: Packed, nodes: np.ndarray) -> np.ndarray:
    """Which nodes may occur in pairs (no wanted node is missed)."""
    bits, at = filter_.array(), _at(nodes)
    return (bits[at >> 3] >> (at & 7)) & 1 == 1


def overlap(a: np.ndarray, b: np.ndarray, least: int, block: int = 512) -> int:
    """Common hashes of two sorted sets, by binary probes of the longer with the shorter's in blocks; stops once ``least`` is
    out of reach (the result is then below it)."""
    if len(a) > len(b):
        a, b = b, a
    total = 0
    for i in range(0, len(a), block):
        part = a[i : i + block]
        at = np.searchsorted(b, part)
        at[at == len(b)] = len(b) - 1
        total += int((b[at] == part).sum())
        if total + len(a) - i - len(part) < least:
            break
    return total


def sifted(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures (node, sig) allow a link. The wider one is folded to the narrower's width, which keeps parities."""
    own = signatures.where(F.col("sig").isNotNull()).groupBy("node").agg(F.min("sig").alias("sig"))
    both = pairs.join(own.select(F.col("node").alias("c"), F.col("sig").alias("sc")), "c")
    both = both.join(own.select(F.col("node").alias("q"), F.col("sig").alias("sq")), "q")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i, (x, y, n, m) in enumerate(zip(b.column("sq"), b.column("sc"), b.column("nq").to_pylist(), b.column("nc").to_pylist())):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                w = min(len(x), len(y))
                apart = np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, w)) ^ np.bitwise_xor.reduce(y.reshape(-1, w))).sum()
                if apart <= n + m - 2 * need(n, m, percent):
                    keep.append(i)
            yield b.select(["q", "nq", "c", "nc"]).take(pa.array(keep, pa.int64()))

    return both.select("q", "nq", "c", "nc", "sq", "sc").mapInArrow(sift, PAIR)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (q, c) that link, by their whole sets (node, hashes: little-endian sorted 64-bit)."""
    own = sets.dropDuplicates(["node"])
    both = pairs.join(own.select(F.col("node").alias("c"), F.col("hashes").alias("hc")), "c")
    both = both.join(own.select(F.col("node").alias("q"), F.col("hashes").alias("hq")), "q")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column("hq"), b.column("hc"))):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                t = need(len(x), len(y), percent)
                if overlap(x, y, t) >= t:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column("q").take(pa.array(keep, pa.int64())), b.column("c").take(pa.array(keep, pa.int64()))], names=["a", "b"])

    return both.select("q", "c", "hq", "hc").mapInArrow(probe, "a long, b long")


def _shared(lists: DataFrame) -> DataFrame:
    """A small table of lists, broadcast if it is found to be small; else the join deals with skew at run time."""
    lists = materialize(lists, "list-state")
    return F.broadcast(lists) if lists.count() <= SMALL else lists


def sketches(found: DataFrame, signatures: DataFrame) -> DataFrame:
    """(node, SKETCH) of nodes of the lists in ``found`` that left pairs out, from signatures (node, sig)."""
    held = found.where(F.col("c").isNull()).select(F.col("q").alias("node")).distinct()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = np.zeros((b.num_rows, len(SKETCH)), np.int64)
            for k, sig in enumerate(b.column("sig")):
                w = np.frombuffer(sig.as_buffer(), "<i8")
                width = min(len(w), len(SKETCH))
                words[k, :width] = np.bitwise_xor.reduce(w.reshape(-1, width))
            yield pa.RecordBatch.from_arrays([b.column("node"), *map(pa.array, np.ascontiguousarray(words.T))], names=["node", *SKETCH])

    own = signatures.where(F.col("sig").isNotNull()).join(held, "node", "left_semi")
    return own.mapInArrow(fold, ", ".join(f"{c} long" for c in ["node", *SKETCH])).dropDuplicates(["node"])


def _members(found: DataFrame, state: DataFrame, components: bool, sketched: DataFrame | None = None) -> DataFrame:
    """Postings of the lists in ``found`` that left pairs out, with s (and o) and their sketches, whether the posting is ``live`` (outside its list's
    settled bulk: each open pair has a live one), and how many of both the list has; lists without open pairs are gone."""
    crowded = found.where(F.col("c").isNull()).select("home", F.col("q").alias("node"), "size", "b0", "b1")
    if sketched is not None:
        crowded = crowded.join(sketched, "node")
    told = crowded.join(state, "node", "left").withColumn("s", F.coalesce("s", "node" if components else F.lit(0)).cast("long"))
    told = materialize(told if components else told.withColumn("o", F.coalesce("o", F.lit(0)).cast("long")), "long-lists")
    if components:
        each = told.groupBy("home", "s").agg(F.count("*").alias("n"))
        lists = each.groupBy("home").agg(F.sum("n").alias("all"), F.max_by("s", F.struct("n", "s")).alias("bulk"), F.max("n").alias("most"))
        lists = lists.where(F.col("most") < F.col("all")).select("home", "bulk", "all", (F.col("all") - F.col("most")).alias("lives"))
        return told.join(_shared(lists), "home").withColumn("live", F.col("s") != F.col("bulk")).drop("bulk")
    live = F.col("s") == 0
    lists = told.groupBy("home").agg(F.count("*").alias("all"), F.count_if(live).alias("lives"), F.min("o").alias("least"), F.min(F.when(live, F.col("o"))).alias("live_least"))
    lists = lists.where((F.col("lives") > 1) | (F.col("live_least") > F.col("least"))).select("home", "all", "lives")
    return told.join(_shared(lists), "home").withColumn("live", live)


def left_over(found: DataFrame, state: DataFrame, percent: int, few: int | None = None, components: bool = True, occurrences: int = 1, cell: int = CELL, sketched: DataFrame | None = None) -> DataFrame:
    """Pairs of the crowded and cut lists in ``found`` that the rounds before have not settled: (q, nq, c, nc), distinct.

    ``state`` tells what those rounds decided about nodes. With ``components`` it is (node, s), s being a component (the node
    itself, if absent), and pairs within one are settled. Otherwise it is (node, s, o): a place and whether an earlier
    partner is known (s = 1); pairs whose later node has one are settled. With ``few``, each node of a cell is paired only with so many
    unsettled ones, the least nodes or earliest places (and so many for two components); without, with all. ``sketched`` (see
    ``sketches``) keeps pairs in the cells that differ in too many bits.
    """
    extra = [*(["s"] if components else ["s", "o"]), *(SKETCH if sketched is not None else [])]
    names = [*POSTING, *extra, "probe"]
    slack = occurrences - 1
    members = _members(found, state, components, sketched)
    side = F.greatest(F.lit(cell), F.least(F.lit(16 * cell), F.col("all") / 64))  # longer lists have larger cells, up to a bound
    rows, columns = F.ceil(F.col("all") / side).cast("int"), F.ceil(F.col("lives") / side).cast("int")
    # A cell holds a part of the list and a part of its live postings, the probes.
    as_member = members.select("*", F.pmod(F.xxhash64("node"), rows).alias("row"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("column"), F.lit(0).alias("probe"))
    as_probe = members.where("live").select("*", F.explode(F.sequence(F.lit(0), rows - 1)).alias("row"), F.pmod(F.xxhash64("node"), columns).alias("column"), F.lit(1).alias("probe"))
    n16 = F.least(F.shiftright("size", 32), F.lit(65535))
    cells = as_member.unionByName(as_probe).select(F.xxhash64("home", "row", "column").bitwiseAND(~65535).bitwiseOR(n16).alias("k"), "node", "size", "b0", "b1", *extra, "probe")

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, node, size, b0, b1, s, *rest, probe in _blocks(batches, names):
            n, pos = size >> 32, size & 0xFFFFFFFF
            sketch = rest[not components :]
            if components:
                order = node
                i, j = _pairs(ids, node, n, pos, (b0, b1), percent, slack, lambda i, j: (probe[i] != probe[j]) & (s[i] != s[j]), sketch)
            else:
                order = rest[0]

                def open_(i, j):
                    return (probe[i] != probe[j]) & ~(((s[i] == 1) | (order[i] < order[j])) & ((s[j] == 1) | (order[j] < order[i])))  # noqa: B023

                i, j = _pairs(ids, node, n, pos, (b0, b1), percent, slack, open_, sketch)
                turn = order[i] > order[j]
                i, j = np.where(turn, j, i), np.where(turn, i, j)
            if few is not None and len(i):
                keep = _first(i, j, order, few)
                if components:  # nor more than a few for any two components of a cell
                    a, b = np.minimum(s[i], s[j]), np.maximum(s[i], s[j])
                    o_ = np.lexsort((order[i], b, a, ids[i]))
                    head = np.ones(len(o_), bool)
                    head[1:] = (a[o_][1:] != a[o_][:-1]) | (b[o_][1:] != b[o_][:-1]) | (ids[i][o_][1:] != ids[i][o_][:-1])
                    start = np.flatnonzero(head)
                    keep[o_] &= np.arange(len(o_)) - np.repeat(start, np.diff(np.append(start, len(o_)))) < few
                i, j = i[keep], j[keep]
            swap = node[i] > node[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            for at in range(0, len(i), 1 << 16):
                x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(n[x], pa.int32()), pa.array(node[y]), pa.array(n[y], pa.int32())], names=["q", "nq", "c", "nc"])

    return cells.repartition(_list_id()).sortWithinPartitions("k").mapInArrow(cross, PAIR).distinct()
