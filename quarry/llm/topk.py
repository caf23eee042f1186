"""Exact top-k inner-product search by columnar branch and bound.

Queries and candidates are dealt into blocks. A task holds one block of either in vertical layout
(one row of the matrix per dimension) and adds up scores dimension block by dimension block. After
each one the Cauchy-Schwarz bound on the remaining dimensions is added to every partial score;
candidates that no query can still use are compacted away.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
DIM_BLOCK = 16


def _exact_dtype(q: np.ndarray, c: np.ndarray):
    """float64 while every partial sum is an exact integer in it, else int64, else Python's ints."""
    size = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    return np.float64 if size < 2**52 else np.int64 if size < 2**62 else object


def block_top_k(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int,
                dim_block: int = DIM_BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of each query's k best candidates of another id; ties go
    to smaller ids. ``q`` and ``c`` hold integers as float64 rows."""
    kind = _exact_dtype(q, c)
    order = np.lexsort((c_ids, -np.square(c).sum(axis=1)))
    c, c_ids = c[order], c_ids[order]
    if kind is not np.float64:
        to = np.vectorize(int, otypes=[object])
        q, c = (to(x) if x.size else x.astype(object) for x in (q, c))
        if kind is np.int64:
            q, c = q.astype(np.int64), c.astype(np.int64)
    rows, cols = np.ascontiguousarray(q.T), np.ascontiguousarray(c.T)
    dims = len(rows)
    same = q_ids[:, None] == c_ids[None, :]
    again = np.ones(len(c_ids), bool)   # all rows of an id but one, which stands for it in bounds
    again[np.unique(c_ids, return_index=True)[1]] = False
    low = np.iinfo(np.int64).min if kind is not np.float64 else -np.inf

    def kth_of(scores: np.ndarray, own: np.ndarray) -> np.ndarray:
        """A lower bound on each query's k-th best score of distinct ids, or none where there are fewer."""
        if scores.shape[1] <= k:
            return np.full(len(q_ids), -np.inf)
        s = np.where(own, low, scores).astype(np.float64)
        s = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        return np.where(s <= -9e18, -np.inf, s)

    seed = min(len(c_ids), max(4 * k, 64))  # the longest vectors, scored in full, give the first thresholds
    floor = kth_of(rows.T.dot(cols[:, :seed]), (same | again)[:, :seed])
    alive = np.arange(len(c_ids))
    partial = np.zeros((len(q_ids), len(c_ids)), kind)
    done = 0
    while done < dims:
        hi = min(dims, done + dim_block)
        partial = partial + rows[done:hi].T.dot(cols[done:hi][:, alive])
        done = hi
        if done < dims and len(alive) > k:
            rest_q = np.sqrt(np.square(rows[done:].astype(np.float64)).sum(axis=0))
            rest_c = np.sqrt(np.square(cols[done:][:, alive].astype(np.float64)).sum(axis=0))
            mass = np.multiply.outer(rest_q, rest_c) * (1 + 1e-9) + 1e-6
            now = partial.astype(np.float64)
            floor = np.maximum(floor, kth_of(now - mass, (same | again)[:, alive]))
            slack = np.abs(now) * 1e-12 + np.abs(floor)[:, None] * 1e-12 if kind is not np.float64 else 0
            useful = (now + mass + slack >= floor[:, None]).any(axis=0)
            if not useful.all():
                alive, partial = alive[useful], partial[:, useful]
    own = same[:, alive]
    out_q, out_c, out_s = [], [], []
    ids = c_ids[alive]
    for x in range(len(q_ids)):
        scores, cand = partial[x][~own[x]], ids[~own[x]]
        if again.any() and len(cand):   # an id's best row
            by_id = np.argsort(cand, kind="stable")
            cand, starts = np.unique(cand[by_id], return_index=True)
            scores = np.maximum.reduceat(scores[by_id], starts)
        if len(cand) > k:
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = scores >= cut
            scores, cand = scores[keep], cand[keep]
        best = sorted(zip([-int(s) for s in scores], cand.tolist(), strict=True))
        chosen = {}
        for s, i in best:
            if len(chosen) == k:
                break
            chosen.setdefault(i, -s)
        out_q += [int(q_ids[x])] * len(chosen)
        out_c += list(chosen)
        out_s += [max(-2**63, min(2**63 - 1, s)) for s in chosen.values()]
    return np.array(out_q, np.int64), np.array(out_c, np.int64), np.array(out_s, np.int64)


def _unique_rows(ids: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeated rows (id and vector) once."""
    known, code = np.unique(ids, return_inverse=True)
    if len(known) == len(ids):
        return ids, m
    _, at = np.unique(np.column_stack([code.astype(np.float64), m]), axis=0, return_index=True)
    return ids[np.sort(at)], m[np.sort(at)]


def _matrix(t: pa.Table) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Ids and rows by vector length."""
    ids = t.column("id").to_numpy()
    v = t.column("v").combine_chunks()
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
    n = v.value_lengths().to_numpy()
    flat, ends = v.flatten().to_numpy(zero_copy_only=False), np.cumsum(n)
    out = {}
    for d in np.unique(n):
        rows = np.flatnonzero(n == d)
        out[int(d)] = _unique_rows(ids[rows], flat[(ends[rows] - d)[:, None] + np.arange(d)])
    return out


def _block(k: int):
    names = ["query_id", "vec_id", "score"]

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        parts = []
        if q.num_rows and c.num_rows:
            right = _matrix(c)
            for d, (ids, rows) in _matrix(q).items():
                if d in right:
                    for lo in range(0, len(ids), 256):
                        parts.append(block_top_k(rows[lo: lo + 256], ids[lo: lo + 256], right[d][1], right[d][0], k))
        cat = [np.concatenate([p[j] for p in parts]) if parts else np.empty(0, np.int64) for j in range(3)]
        return pa.table(dict(zip(names, cat, strict=True)))
    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                scale: float = 256.0, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """Each query's ``k`` highest scores (query_id, rank, vec_id, score) among rows of another id.

    Components become floor(scale * x); the score is their inner product, exact, ties to the
    smaller id. Defined cases: a null id, a null vector, or one with a null or non-finite
    component takes no part; vectors of unlike lengths are not compared; a repeated row counts
    once and an id's best row counts if its rows differ; fewer than ``k`` candidates give as many
    rows as there are; an empty table gives none. Scores beyond 64 bits are held at the limit.

    Scale: candidates and queries are dealt to blocks of bounded size by row number, whatever
    the ids. Each pair of blocks is one group, so both sides are sent once per block of the other;
    only ``k`` rows per query and block go on. No side is broadcast or collected.
    """
    def clean(df: DataFrame) -> DataFrame:
        v = F.col(vec_col).cast("array<double>")
        ok = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(
            v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        return df.filter(ok).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))

    def dealt(df: DataFrame, name: str, blocks: int, other: str, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
        return df.withColumn(name, mine).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))

    cand, quer = clean(vectors), clean(queries)
    n_c, n_q = cand.count(), quer.count()
    g, h = max(1, -(-n_c // candidate_block)), max(1, -(-n_q // query_block))
    # floor() in the task: Spark's gives a long, which large components overflow
    def scaled(t: pa.Table) -> pa.Table:
        v = t.column("v").combine_chunks()
        v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
        flat = np.floor(v.flatten().to_numpy(zero_copy_only=False) * scale)
        off = np.concatenate([[0], np.cumsum(v.value_lengths().to_numpy())]).astype(np.int32)
        return pa.table({"id": t.column("id"), "v": pa.ListArray.from_arrays(pa.array(off), pa.array(flat))})

    inner = _block(k)
    best = (dealt(quer, "h", h, "g", g).groupBy("g", "h").cogroup(dealt(cand, "g", g, "h", h).groupBy("g", "h"))
            .applyInArrow(lambda q, c: inner(scaled(q), scaled(c)), "query_id long, vec_id long, score long"))
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
