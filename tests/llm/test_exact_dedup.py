import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import exact_dedup, queries
from tests.llm.data import AWKWARD, SCHEMA, SF01, awkward, clashing, table


def brute(rows):
    """Sorted (doc_id, keep_id, group_size, kept, text_sha256) by plain Python."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for body, members in groups.items():
        members.sort(key=lambda m: m[:3])
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), k == 0, digest) for k, m in enumerate(members)]
    return sorted(out, key=repr)


def got(df, **options):
    return sorted(map(tuple, exact_dedup.exact_duplicates(df, digest_all=True, **options).collect()), key=repr)


def test_query_matches_brute_force(spark):
    out = queries.op13_exact_dedup(spark, SF01)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = brute([(d["doc_id"], d["text"]) for d in table("documents")])
    assert sorted(map(tuple, out.collect()), key=repr) == want
    assert any(r[2] > 2 for r in want)


def test_awkward_documents(spark):
    want = brute([(r[0], r[1]) for r in AWKWARD])
    assert got(awkward(spark)) == want
    assert got(clashing(spark)) == want
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(3, "a b"), (2, "ab "), (9, "a  b"), (None, "a  b"), (9, "a  b"), (None, "x"), (None, "x"), (-(1 << 63), "q"), ((1 << 63) - 1, "q"),
            (7, None), (6, " \t"), (5, ""), (4, "\x1c"), (1, "　")]
    out = got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out == brute(rows)
    assert [r for r in out if r[0] == 9 and r[3]] == [(9, 9, 5, True, hashlib.sha256(b"ab").hexdigest())]   # one of two equal rows


@pytest.mark.parametrize("bits,share", [(8, 1), (1 << 25, 1000), (64, 100_000)])
def test_small_tables_heavy_groups_and_shared_prefixes(spark, monkeypatch, bits, share):
    """Full bit tables only let more rows through; heavy and light groups give the same rows."""
    monkeypatch.setattr(exact_dedup, "TABLE_BITS", bits)
    monkeypatch.setattr(exact_dedup, "HEAVY_SHARE", share)
    rng = random.Random(5)
    rows = [(i, "hot  copy" if i % 3 == 0 else "p" * 70 + rng.choice("abc") * rng.randint(1, 4) + " " * rng.randint(0, 2) if i % 3 == 1 else f"alone {i}") for i in range(600)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), prefix_chars=8) == brute(rows)


def test_levels_leave_out_what_cannot_be_equal(spark):
    """The full hash is taken only of rows whose length and prefix occur again."""
    rows = [(1, "aaaa"), (2, "bbb"), (3, "cc c"), (4, "x" * 9 + "1"), (5, "x" * 9 + "2"), (6, "dd d d")]
    out = {r["doc_id"]: r["text_sha256"] for r in exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), prefix_chars=9).collect()}
    assert {i for i, sha in out.items() if sha} == {4, 5}


def test_plan_has_no_python_and_shuffles_no_text(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = exact_dedup.exact_duplicates(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    bits = exact_dedup.repeated_keys(docs.select(F.length("text").alias("size")), "size")
    assert "text" not in [f.name for f in bits.schema]
