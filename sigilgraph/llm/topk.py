"""Operator 10: exact top-k inner products by a pivot-distance index.

Integer vectors are lifted by one component to equal length: with M the greatest squared length,
|q,0 - x,sqrt(M-|x|^2)|^2 = |q|^2 + M - 2 q.x, so the nearest lifted vectors have the highest scores. Each
vector is keyed by its nearest pivot and its distance to it. A query looks at a pivot's vectors in annuli
around its own distance, and stops once the triangle inequality |d(q,p) - d(x,p)| > radius rules out the
rest, radius being the distance of its k-th best so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Vectors of a cell (pivot and salt) that one group holds.
CELL_ROWS = 8192
#: Vectors looked at on each side of a query's distance before the bound is renewed.
STEP = 256


def integer_vectors(embeddings: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component. Vectors that are null, empty or hold a null or a
    non-finite component, and rows without vec_id, take no part; repeated rows stay. A shorter vector
    counts as padded with zeros. A component beyond the range of long stands at its end."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    ok = (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return embeddings.where(F.col("vec_id").isNotNull() & F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    off = np.asarray(column.offsets)
    flat = np.asarray(column.flatten(), np.float64)
    size = np.diff(off)
    if (size == dim).all():
        return flat.reshape(len(column), dim)
    out = np.zeros((len(column), dim))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(off[:-1] - off[0], size)] = flat
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, *, pivots: int = 48, sample: int = 2048, query_block: int = 20_000) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest integer inner products of each query with all rows of
    ``vectors`` but those with its own vec_id; ties go to the smaller vec_id.

    Scores are exact while they fit 2**53; greater ones are rounded as doubles and stand at the ends of long beyond them. Pivots are rows of a bounded ``sample`` (least hashes), spread by
    farthest-first choice; they affect speed alone. Queries run in blocks of at most ``query_block``, each
    broadcast, so memory is bounded whatever the query set's size. A pivot with more than CELL_ROWS vectors is
    salted by a hash of vec_id into groups of about that size. Empty inputs give no rows; a repeated query id
    gives the answer of its least vector.
    """
    spark = vectors.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score long"
    top = vectors.agg(F.max(F.size("v")), F.max(F.expr("aggregate(v, 0D, (a, x) -> a + CAST(x AS DOUBLE) * x)")), F.count("*")).first()
    dim, longest, count = top
    if not count:
        return spark.createDataFrame([], out_schema)
    longest = float(longest)
    lift = lambda m: np.hstack([m, np.sqrt(np.maximum(longest - (m * m).sum(1), 0))[:, None]])
    own_ids = [r["vec_id"] for r in vectors.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    picked = vectors.where(F.col("vec_id").isin(own_ids)).groupBy("vec_id").agg(F.min("v").alias("v")).toArrow()  # at most sample rows
    pool = lift(_matrix(picked.column("v").combine_chunks(), dim))
    chosen, gap = [0], _distances(pool, pool[:1])[:, 0]
    while len(chosen) < min(pivots, len(pool)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(pool, pool[chosen[-1:]])[:, 0])
    centres = pool[chosen]

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("v"), dim)
            d = _distances(lift(m), centres)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), pa.array(list(m.astype("<f8")), pa.list_(pa.float64()))], names=["vec_id", "pivot", "dist", "v"])

    index = materialize(vectors.mapInArrow(key, "vec_id long, pivot int, dist double, v array<double>"), "pivot-index")
    cells = {r["pivot"]: -(-r["n"] // CELL_ROWS) for r in index.groupBy("pivot").agg(F.count("*").alias("n")).collect()}  # a row for each pivot
    salts = F.create_map(*[F.lit(x).cast("int") for kv in cells.items() for x in kv])
    cell = index.withColumn("cell", F.pmod(F.xxhash64("vec_id"), salts[F.col("pivot")]).cast("int"))

    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n_blocks = max(1, -(-asked.count() // query_block))
    found = []
    for block in range(n_blocks):
        part = asked if n_blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == block)
        rows = part.toArrow()  # at most about query_block rows
        if not rows.num_rows:
            continue
        q_ids = np.asarray(rows.column("vec_id").combine_chunks(), np.int64)
        q = _matrix(rows.column("v").combine_chunks(), dim)
        seen = spark.sparkContext.broadcast((q_ids, q))

        def search(groups, seen=seen):
            ids_q, q = seen.value
            lifted = np.hstack([q, np.zeros((len(q), 1))])
            to_pivot, q2 = _distances(lifted, centres), (q * q).sum(1)
            # A first bound: the k-th best of the sample, leaving out the query's own row.
            first = np.full(len(q), -np.inf)
            pool_ids = np.asarray(picked.column("vec_id").combine_chunks(), np.int64)
            for i in range(0, len(q), 256):
                s = q[i : i + 256] @ pool[:, :-1].T
                s[ids_q[i : i + 256, None] == pool_ids[None]] = -np.inf
                if s.shape[1] >= k:
                    first[i : i + 256] = -np.partition(-s, k - 1, axis=1)[:, k - 1]
            for b in groups:
                pivot = int(b.column("pivot")[0].as_py())
                dist = np.asarray(b.column("dist"))
                order = np.argsort(dist, kind="stable")
                dist, ids, x = dist[order], np.asarray(b.column("vec_id"), np.int64)[order], _matrix(b.column("v"), dim)[order]
                res: list[tuple] = []
                for i in range(len(q)):
                    kth, best_s, best_i = first[i], np.zeros(0), np.zeros(0, np.int64)
                    centre = to_pivot[i, pivot]
                    lo = hi = int(np.searchsorted(dist, centre))
                    while True:
                        radius = np.sqrt(max(q2[i] + longest - 2 * kth, 0)) * (1 + 1e-9) + 1e-6 + 1e-7 * np.sqrt(longest) if kth > -np.inf else np.inf
                        left = int(np.searchsorted(dist, centre - radius, "left"))
                        right = int(np.searchsorted(dist, centre + radius, "right"))
                        a, z = max(left, lo - STEP), min(right, hi + STEP)
                        if a >= lo and z <= hi:
                            break
                        ring = np.r_[min(a, lo) : lo, hi : max(z, hi)]
                        lo, hi = min(a, lo), max(z, hi)
                        s = x[ring] @ q[i]
                        keep = (s >= kth) & (ids[ring] != ids_q[i])
                        best_s, best_i = np.concatenate([best_s, s[keep]]), np.concatenate([best_i, ids[ring][keep]])
                        if len(best_s) > k:
                            o = np.lexsort((best_i, -best_s))[:k]
                            best_s, best_i = best_s[o], best_i[o]
                        if len(best_s) == k:
                            kth = max(kth, best_s.min())
                    res += [(int(ids_q[i]), int(v), max(-(1 << 63), min((1 << 63) - 1, int(s)))) for s, v in zip(best_s, best_i)]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in res], pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"])

        def per_cell(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            """Groups of a partition that is sorted by pivot and cell, each of bounded size."""

            def groups():
                held, at = [], None
                for b in batches:
                    if not b.num_rows:
                        continue
                    tag = np.asarray(b.column("pivot"), np.int64) << 32 | np.asarray(b.column("cell"), np.int64)
                    cuts = [0, *(np.flatnonzero(np.diff(tag)) + 1), b.num_rows]
                    for i, j in zip(cuts, cuts[1:]):
                        if held and at != tag[i]:
                            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                            held = []
                        at = tag[i]
                        held.append(b.slice(i, j - i))
                if held:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

            yield from search(groups())

        dealt = cell.repartition("pivot", "cell").sortWithinPartitions("pivot", "cell")
        found.append(dealt.mapInArrow(per_cell, "query_id long, vec_id long, score long"))
    if not found:
        return spark.createDataFrame([], out_schema)
    merged = found[0]
    for f in found[1:]:
        merged = merged.unionByName(f)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return merged.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
