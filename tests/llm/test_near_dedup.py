import random
import re

import numpy as np

from quarry.llm import near_dedup
from quarry.llm.near_dedup import least_matches, near_duplicates
from quarry.llm.queries import op3_minhash_dedup
from tests.llm.data import AWKWARD, SF01, awkward, clashing, table


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k, num=80, den=100):
    """Rows with components over all linked pairs; pairs are found through an inverted index."""
    sets = [shingles(t, k) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    where = {}
    for r, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(r)
    for r, s in enumerate(sets):
        shared = {}
        for x in s:
            for o in where[x]:
                if o < r:
                    shared[o] = shared.get(o, 0) + 1
        for o, n in shared.items():
            if den * n >= num * (len(s) + len(sets[o]) - n) and None not in (rows[r][0], rows[o][0]):
                a, b = find(rows[r][0]), find(rows[o][0])
                root[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, _), s in zip(rows, sets)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_query_matches_brute_force(spark):
    assert got(op3_minhash_dedup(spark, SF01)) == brute([(d["doc_id"], d["text"]) for d in table("documents")], 2)


def test_awkward_documents(spark):
    want = {k: brute([(r[0], r[1]) for r in AWKWARD], k) for k in (2, 5)}
    assert got(near_duplicates(awkward(spark), shingle_words=2)) == want[2]
    assert got(near_duplicates(clashing(spark))) == want[5]
    assert got(near_duplicates(awkward(spark).limit(0))) == []


def test_chain_and_large_group(spark):
    """A chain of small edits is one component though its ends differ; a hot group of copies and
    near copies, and documents that share a passage only, come out as by brute force."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(6))
    rows, text = [], [word() for _ in range(100)]
    for i in range(40):
        rows.append((i, " ".join(text)))
        text[rng.randrange(100)] = word()
    passage = [word() for _ in range(60)]
    for i in range(100, 220):
        rows.append((i, " ".join(passage + [word() for _ in range(rng.randint(2, 60))])))
    for i in range(300, 420):
        rows.append((i, " ".join(passage)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_duplicates(df, shingle_words=2)) == brute(rows, 2)


def test_blocks_of_a_bucket(spark):
    """Groups that the first rounds leave apart meet block against block, whatever the block size."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(6))
    rows, core = [], [word() for _ in range(70)]
    for i in range(60):
        text = list(core)
        for _ in range(rng.randint(2, 6)):
            text[rng.randrange(70)] = word()
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2)
    assert 1 < len({r[2] for r in want}) < 60
    for near_dedup.CHUNK in (3, 16):
        assert got(near_duplicates(df, shingle_words=2)) == want
    near_dedup.CHUNK = 512


def test_pairs_among_likelier_single_texts(spark):
    """A family of one template: pairs just above the threshold are found among single texts just
    below it, many of which look likelier by their sketches; whatever the block size."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(6))
    base, edits = [word() for _ in range(240)], []
    while len(edits) < 80:
        a = set(rng.sample(range(1, 239, 2), 8))
        b = set(rng.sample(sorted(a), 3) + rng.sample(sorted(set(range(1, 239, 2)) - a), 5))
        if all(len(x & y) < 3 for x in edits for y in (a, b)):
            edits += [a, b]
    ids = rng.sample(range(1000), len(edits))
    rows = [(i, " ".join(word() if p in e else base[p] for p in range(240))) for i, e in zip(ids, edits, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2)
    assert len({r[2] for r in want}) == 40
    assert got(near_duplicates(df, shingle_words=2)) == want
    try:
        near_dedup.CHUNK = 7
        assert got(near_duplicates(df, shingle_words=2)) == want
    finally:
        near_dedup.CHUNK = 512


def test_pruning_keeps_similar_pairs():
    rng = np.random.default_rng(1)
    least = least_matches(150, 0.8, 1e-6)
    n = 200_000
    same = rng.random((n, 1)) < 2  # all pairs at similarity 0.8
    matches = np.zeros(n, int)
    alive = same[:, 0]
    done = 0
    for upto, m in least:
        matches += rng.binomial(upto - done, 0.8 + 0.2 / 256, n)
        alive &= matches >= m
        done = upto
    assert alive.mean() > 0.9999
    assert all(m > 0 for _, m in least[1:])
