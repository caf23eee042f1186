import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import fim, queries
from quarry.llm._common import text_buffer
from tests.llm.data import AWKWARD, SCHEMA, SF01, awkward, clashing, table

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(i, text):
    """(n, form, prefix_chars, middle_chars, output) by the definition, one text at a time."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k: k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    out = []
    for i, text in rows:
        n, form, p, m, output = brute(i, text)
        out.append((i, n, form, p, m, sha(output), sha(text or "")))
    return sorted(out, key=repr)


def derived(df):
    return sorted(map(tuple, queries.fim_digests(df).collect()), key=repr)


def test_query_matches_definition(spark):
    got = queries.op11_fill_in_middle(spark, SF01)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    rows = [(d["doc_id"], d["text"]) for d in table("documents")]
    want = expected(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


MARKED = [(100 + i, t, "en", "x", 0) for i, t in enumerate(["<P>", "a <S> b", "x<M", "<<P", "P><", "a <P b <S c <M d", "<P><S><M>", " ", "\n\na", "a\n\n"])]


def test_awkward_documents(spark):
    rows = AWKWARD + MARKED
    want = expected([(r[0], r[1]) for r in rows])
    assert derived(spark.createDataFrame(rows, SCHEMA)) == want
    assert derived(clashing(spark)) == expected([(r[0], r[1]) for r in AWKWARD])
    assert derived(awkward(spark).filter("doc_id < 0")) == []


def test_restore_keeps_clashing_columns_and_nulls(spark):
    rows = [(None, "plain", 1, "a"), ("<P>a<S>b<M>c", "psm", 2, None), ("<S>b<P>a<M>c", "spm", 3, "b"), ("as is", None, 4, "c"), ("as is", "other", 5, "d")]
    df = spark.createDataFrame(rows, "output string, form string, restored long, `a.b` string")
    got = fim.restore(df).collect()
    assert fim.restore(df).columns == ["output", "form", "a.b", "restored"]
    assert [r["restored"] for r in got] == ["", "acb", "acb", "as is", "as is"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aé漢\U0001f600 \n\t\x0b\x1c\x85　<>PSM", max_size=60), min_size=1, max_size=30), st.integers(1, 64))
def test_scatter_and_gather_are_inverse(texts, slice_bytes):
    data, offsets = text_buffer(pa.array(texts))
    draws = np.array([fim.seeds(i) for i in range(len(texts))], np.int64)
    before, fim.SLICE = fim.SLICE, slice_bytes   # displacements carried over many slices
    try:
        out, to, forms, units, _ = fim.transform_batch(data, offsets, draws)
        back, back_to = fim.restore_batch(out, to, forms)
    finally:
        fim.SLICE = before
    raw = out.tobytes()
    got = [(int(u), fim.FORMS[f], raw[a:b].decode()) for u, f, a, b in zip(units, forms, to, to[1:])]
    assert got == [(n, f, o) for n, f, _, _, o in map(brute, range(len(texts)), texts)]
    assert back.tobytes() == data.tobytes() and back_to.tolist() == offsets.tolist()


@pytest.mark.parametrize("percent", [0, 100])
def test_rates(spark, percent):
    forms = {r["form"] for r in fim.fill_in_middle(spark.createDataFrame([(i, "a b c") for i in range(50)], "doc_id long, text string"),
                                                   fim_percent=100, spm_percent=percent).collect()}
    assert forms == {"psm" if percent == 0 else "spm"}
