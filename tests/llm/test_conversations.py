import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import conversations as cv
from quarry.llm import queries
from tests.llm.data import SF01, table

BARE = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired turns) by a search over whole audits: least cost, then least text."""
    faults = [r[2] for r in rows]
    n = len(rows)
    best = {(n, "A"): (0, "", ()), (n, "0"): (0, "", ())}

    @lru_cache(None)
    def inserted(i, state, depth):
        options = [best[i, state]] if (i, state) in best and depth >= 0 else []
        if depth < 2:
            to = "A" if state == "U" else "U"
            rest = inserted(i, to, depth + 1)
            if rest:
                options.append((rest[0] + 3, "I" + rest[1], (({"U": "user", "A": "assistant"}[to], ""),) + rest[2]))
        return min(options, default=None)
    after = {s: inserted(n, s, 0) for s in "0SUA"}
    for i in range(n - 1, -1, -1):
        role, text, fault = rows[i][0], rows[i][1], faults[i]
        here = {}
        for s in "0SUA":
            c, a, t = after[s]
            options = [(c + 4, "D" + a, t)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                to = "A" if s == "U" else "U"
                c, a, t = after[to]
                options.append((c + 3 + more, "R" + a, (({"U": "user", "A": "assistant"}[to], text),) + t))
                first = role[:1]
                if (s, first) in {("0", "s"), ("0", "u"), ("S", "u"), ("A", "u"), ("U", "a")}:
                    c, a, t = after[first.upper()]
                    options.append((c + more, "K" + a, ((role, text),) + t))
            here[s] = min(options)
        widened = {}
        for s in "0SUA":
            options, to, prefix, turns = [here[s]], s, "", ()
            for k in (1, 2):
                to = "A" if to == "U" else "U"
                prefix, turns = prefix + "I", turns + (({"U": "user", "A": "assistant"}[to], ""),)
                options.append((here[to][0] + 3 * k, prefix + here[to][1], turns + here[to][2]))
            widened[s] = min(options)
        after = widened
    return after["0"]


def brute(original, rows):
    """{conv: row of the result} by plain Python."""
    convs = {}
    for conv, *_ in original:
        convs[conv] = []
    for r in rows:
        convs[r[0]].append(r[1:])
    out = []
    for conv, members in convs.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in members:
            last = (BARE.findall(text) or [""])[-1]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        known = [t for t, _, _ in members if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, turns = cheapest(marked)
        body = "\n".join(f"{r}:{t}" for r, t in turns)
        out.append((conv, gaps, *(sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    out = queries.op12_conversation_repair(spark, SF01)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table("conversations")]
    want = brute(rows, damage(rows))
    assert got(out) == want
    assert {"D", "I", "K", "R"} <= set("".join(r[7] for r in want))


def random_rows(seed, convs, turns, roles=("system", "user", "assistant")):
    r = random.Random(seed)
    texts = ["a.", "b?", "c", "", " ", "d!", "e .\n", "f.x"]
    return [(c, r.choice([None, *range(turns)]) if r.random() < 0.1 else t, r.choice(roles), r.choice(texts) if r.random() < 0.5 else f"{t} {c}" + r.choice([".", ""]))
            for c in range(convs) for t in range(r.choice([1, 2, turns]))]


@pytest.mark.parametrize("chunk,fix_ups,fan", [(512, 6, 256), (3, 6, 256), (2, 0, 2), (1, 1, 3)])
def test_chunks_fix_ups_and_products_agree(spark, chunk, fix_ups, fan):
    rows = random_rows(chunk, 12, 40) + [(90, i, "user", f"{i}.") for i in range(60)] + [(91, i, "tool", f"{i}.") for i in range(61)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(cv.audit_conversations(df, chunk=chunk, fix_ups=fix_ups, fan=fan)) == brute(rows, [(c, t, r, x) for c, t, r, x in rows])


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (1, None, "user", "a."), (1, 0, "user", "a."), (1, 5, "assistant", "b"), (None, 1, "system", "x."), (None, 2, "user", "y."),
            (None, 2, "user", "y."), (2, 0, "system", "s."), (3, None, "", ""), (4, 1, "user", "z" * 100_000), (4, 2, "assistant", " " * 5_000 + "."),
            (5, -3, "user", "q."), (5, 3, "assistant", "q."), (6, 0, "user", "one"), (6, 0, "assistant", "two"), (6, 0, "assistant", "two")]
    df = spark.createDataFrame(rows, SCHEMA)
    as_text = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(cv.audit_conversations(df)) == brute(rows, as_text)
    extra = spark.createDataFrame([r + (1, "k", 2) for r in rows], SCHEMA + ", at long, ckey string, copies long")
    assert got(cv.audit_conversations(extra, cv.damaged(extra))) == brute(rows, damage(rows))
    empty = spark.createDataFrame([], SCHEMA)
    assert got(cv.audit_conversations(empty, cv.damaged(empty))) == []


def test_every_row_dropped_gives_zeros(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "a.")], SCHEMA)
    assert got(cv.audit_conversations(df, cv.damaged(df))) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_hot_conversation_is_spread_and_equal_rows_are_one(spark):
    """A conversation with most rows, many of them equal, is cut over the tasks."""
    rows = [(7, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(3000)] + [(7, 9, "user", "same.")] * 2000 + [(c, 0, "user", "hi.") for c in range(100, 140)]
    df = spark.createDataFrame(rows, SCHEMA)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")   # these rows are too few to be left in several partitions
    try:
        sizes = [len(x) for x in cv._ordered_rows(cv.keyed(df)).rdd.glom().collect()]
    finally:
        spark.conf.set(name, before)
    assert sum(sizes) == 3041 and max(sizes) < 1500
    assert got(cv.audit_conversations(df, chunk=64)) == brute(rows, rows)


def test_repaired_turns_read_as_the_grammar(spark):
    rows = random_rows(9, 30, 12)
    out = {}
    for r in sorted(cv.repaired_turns(cv.keyed(spark.createDataFrame(rows, SCHEMA))).collect(), key=lambda r: (r["ckey"], r["piece"], r["position"])):
        out.setdefault(r["ckey"], []).append(r["role"][0])
    assert out and all(re.fullmatch("s?(ua)+", "".join(x)) for x in out.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x"]), st.sampled_from(["", "truncated", "blank", "duplicate"])), max_size=14), st.integers(1, 5))
def test_costs_and_audit_of_any_rows(rows, chunk):
    codes = bytes({"s": 1, "u": 2, "a": 3, "x": 0}[r] | (cv.FAULTS[f] if f else 0) for r, f in rows)
    cost, audit, _ = cheapest([(r, "t", f) for r, f in rows])
    vector, total = cv.backward(codes, cv.FINAL)
    assert total + vector[cv.START] == cost
    # the same chunk by chunk, from stitched vectors
    parts = [codes[i: i + chunk] for i in range(0, len(codes), chunk)]
    behind, v = [], cv.FINAL
    for part in reversed(parts):
        behind.append(v)
        v, _ = cv.backward(part, v)
    state, found = cv.START, ""
    for k, (part, after) in enumerate(zip(parts, reversed(behind))):
        edits, state = cv.trace(part, after, state, k == len(parts) - 1)
        found += "".join(edits)
    assert found == audit
