import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarry.llm import simhash
from quarry.llm.queries import op4_simhash
from tests.llm.data import AWKWARD, SF01, awkward, clashing, table


def edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        out.setdefault(i, []).append((len(t), hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def got(rows):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append((r["n_chars"], r["edited_sha256"]))
    return {i: sorted(v) for i, v in out.items()}


def bits(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def check_rows(rows, docs):
    by = {r["doc_id"]: r for r in rows}
    fps = {}
    for i, t in docs:
        assert fps.setdefault(t or "", by[i]["fingerprint"]) == by[i]["fingerprint"]
    ids = sorted(by, reverse=True)
    for k, i in enumerate(ids):
        r, nxt = by[i], by[ids[(k + 1) % len(ids)]]
        assert r["near_edited"] == 1 - bits(r["fingerprint"], r["edited_fingerprint"]) / 64
        assert r["near_next"] == 1 - bits(r["fingerprint"], nxt["fingerprint"]) / 64
        if i % 100 == 0:
            assert r["near_docs"] == sum(bits(r["fingerprint"], o["fingerprint"]) <= 3 for o in by.values()) - 1
        else:
            assert r["near_docs"] is None


def test_query_matches_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in table("documents")]
    rows = op4_simhash(spark, SF01).collect()
    assert got(rows) == edits(docs)
    check_rows(rows, docs)
    assert sum(r["near_edited"] for r in rows) > sum(r["near_next"] for r in rows) + 0.1 * len(rows)


@pytest.mark.parametrize("per_block", [1, 3, 2000])
def test_successors_across_blocks(spark, per_block):
    ids = [-50, 3, 4, 5, 900, 901, 10_000, 10_001, 123_456]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    rows = simhash.successor_texts(df, "doc_id", "text", per_block).filter("extra = 0").collect()
    order = sorted(ids, reverse=True)
    assert {r["doc_id"]: r["next_id"] for r in rows} == {i: order[(k + 1) % len(order)] for k, i in enumerate(order)}
    assert all(r["next_text"] == f"text {r['next_id']}" for r in rows)


def test_blocks_are_sized_by_rows(spark):
    """A far-out id, dense runs, null ids and repeated ones fill no block; the order stays."""
    texts = lambda n, at: [(f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} text {at}{k}") for k in range(n)]
    rows = [(i, f"t{i}") for i in range(3000)] + [(10**12, "far"), (-(1 << 62), "farther")] + [(10**9 + 7 * i, f"u{i}") for i in range(700)]
    rows += [(None, t) for t in texts(600, "n")] + [(5000, t) for t in texts(600, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = simhash.successor_texts(df, "doc_id", "text", 50).filter("extra = 0").collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert {(r["doc_id"], r["text"]): (r["next_id"], r["next_text"]) for r in out} == {a: order[(k + 1) % len(order)] for k, a in enumerate(order)}
    sizes = {}
    for r in out:
        sizes[tuple(r["block"])] = sizes.get(tuple(r["block"]), 0) + 1
    assert max(sizes.values()) <= 150, max(sizes.values())


def test_awkward_documents(spark):
    want = edits([(r[0], r[1]) for r in AWKWARD])
    assert got(simhash.fingerprint_edits(awkward(spark)).collect()) == want
    assert got(simhash.fingerprint_edits(clashing(spark)).collect()) == want
    assert simhash.fingerprint_edits(awkward(spark).limit(0)).collect() == []
    one = simhash.fingerprint_edits(spark.createDataFrame([(7, "abcdef ghi")], "doc_id long, text string")).collect()
    assert got(one) == edits([(7, "abcdef ghi")]) and one[0]["near_next"] == 1.0


def test_search_finds_every_neighbour(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base:
        for d in range(1, 7):
            x = b
            for j in rng.sample(range(64), d):
                x ^= 1 << j
            fps.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps] + [(None,)], "fingerprint long")
    for radius, widths in ((3, simhash.BLOCK_BITS), (2, (16, 16, 16, 16))):
        found = {(r["query_fp"], r["fp"]): r["distance"] for r in simhash.search(df, df, radius, widths=widths).collect()}
        assert found == {(signed(a), signed(b)): n for a in fps for b in fps if (n := bin(a ^ b).count("1")) <= radius}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = simhash.fingerprint(df.withColumn("k", F.lit(1)), ["doc_id"], "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
