import math

import duckdb
import numpy as np
import pytest

from quarry.llm.queries import SQL, op2_exact_topk
from quarry.llm.topk import _unique_rows, block_top_k, exact_top_k
from tests.llm.data import SF01


def brute(rows, query, k):
    v = {}
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            v.setdefault(i, []).append([math.floor(256 * c) for c in x])
    out = []
    for q in v:
        if query(q):
            s = sorted((-max(sum(a * b for a, b in zip(x, y)) for x in v[q] for y in ys if len(y) == len(x)), i)
                       for i, ys in v.items() if i != q and any(len(y) == len(x) for x in v[q] for y in ys))
            out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s[:k])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF01}/embeddings.parquet')")
    assert got(op2_exact_topk(spark, SF01)) == sorted(con.execute(SQL["op2_exact_topk"]).fetchall())


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [0.0, 0.0]),
            (9, [-1.0, -2.0]), (10, [1.0]), (None, [1.0, 2.0]), (11, [0.5, 0.001]), (11, [0.5, 0.001]), (12, [1e-9, -1e-9]), (13, [3.0, 1.0, 2.0])]
    df = spark.createDataFrame([r + (1,) for r in rows], "vec_id long, embedding array<float>, score long")
    for cut in (2, 100):
        assert got(exact_top_k(df, df, 3, query_block=cut, candidate_block=cut)) == brute(
            [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], lambda i: True, 3)
    assert got(exact_top_k(df.limit(0), df.limit(0), 3)) == []


@pytest.mark.parametrize("size", [1.0, 1e5, 1e9, 1e12])
def test_block_is_exact_whatever_the_size(size):
    rng = np.random.default_rng(3)
    c = np.floor(rng.normal(size=(700, 48)) * size)
    c[100:130] = c[99]
    ids = rng.permutation(700)
    q, a, s = block_top_k(c[:40], ids[:40], c, ids, 5)
    ints = [[int(x) for x in r] for r in c]
    for x in range(40):
        best = sorted((-sum(p * r for p, r in zip(ints[x], y)), int(i)) for y, i in zip(ints, ids) if i != ids[x])[:5]
        mine = [(-max(-2**63, min(2**63 - 1, int(s[j]))), int(a[j])) for j in np.flatnonzero(q == ids[x])]
        assert mine == [(-max(-2**63, min(2**63 - 1, -n)), i) for n, i in best]


def test_differing_rows_of_one_id_are_one_candidate(spark):
    """One id on many of the best rows takes one place; the bounds count ids, not rows."""
    rng = np.random.default_rng(4)
    c = rng.integers(-50, 50, (300, 64)).astype(float)
    q = c[:3].copy()
    ids = np.arange(300)
    ids[150:] = 7          # half of the rows are one id, and the best ones
    c[150:] = 2 * q[0] + rng.integers(0, 3, (150, 64))
    q_ids = np.arange(3)
    want = []
    for x in q_ids:
        best = {}
        for i, s in zip(ids.tolist(), (c @ q[x]).tolist()):
            if i != x:
                best[i] = max(best.get(i, s), s)
        want += [(x, i, s) for i, s in sorted(best.items(), key=lambda p: (-p[1], p[0]))[:5]]
    assert sorted(zip(*(x.tolist() for x in block_top_k(q, q_ids, c, ids, 5)))) == sorted(want)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, c / 256)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(q_ids, q / 256)], "vec_id long, embedding array<double>")
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in exact_top_k(df, asked, 5).collect()) == sorted(want)


def test_equal_vectors_of_large_neighbouring_ids_stay():
    ids = np.array([2**53, 2**53 + 1, 2**53 + 1])
    out = _unique_rows(ids, np.ones((3, 4)))
    assert out[0].tolist() == [2**53, 2**53 + 1]
