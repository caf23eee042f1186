import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import langid
from quarry.llm.queries import op9_language_id
from tests.llm.data import AWKWARD, SF01, awkward, clashing, table


def grams(text):
    s = " " + "".join(c.lower()[0] if c.isalpha() else " " for c in text) + " "
    while "  " in s:
        s = s.replace("  ", " ")
    return Counter(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n].strip())


def test_counts_match_a_plain_count():
    text = "Ein schöner Tag, n'est-ce pas? 12 ab  c " * 3
    codes, counts = langid.ngram_counts(text)
    assert sorted(counts.tolist()) == sorted(grams(text).values())
    old = langid.SLICE
    try:
        for langid.SLICE in (1, 2, 3, 7):
            c, n = langid.ngram_counts(text)
            assert np.array_equal(c, codes) and np.array_equal(n, counts)
    finally:
        langid.SLICE = old


def test_query(spark):
    rows = {r["doc_id"]: r for r in op9_language_id(spark, SF01).collect()}
    docs = table("documents")
    assert len(rows) == len(docs)
    right = held = 0
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        if r["held_out"]:
            held += 1
            right += r["lang_pred"] == d["lang"]
    assert held > 100 and right / held > 0.95


def test_distance_matches_definition(spark):
    docs = [d for d in table("documents")[:200] if zlib.crc32(str(d["doc_id"]).encode()) % 5]
    df = spark.createDataFrame([(d["doc_id"], d["text"], d["lang"]) for d in docs], "doc_id long, text string, lang string")
    model = langid.collect_profiles(langid.learn_profiles(df, size=50), 50)
    total = {}
    for d in docs:
        total.setdefault(d["lang"], Counter()).update(dict(zip(*(x.tolist() for x in langid.ngram_counts(d["text"])))))
    top = {lang: [c for c, _ in sorted(n.items(), key=lambda x: (-x[1], x[0]))[:50]] for lang, n in total.items()}
    for d in docs[:40]:
        own = [c for c, _ in sorted(zip(*(x.tolist() for x in langid.ngram_counts(d["text"]))), key=lambda x: (-x[1], x[0]))[:50]]
        gaps = {lang: sum(abs(p.index(c) - k) if c in p else 50 for k, c in enumerate(own)) for lang, p in top.items()}
        best = min(sorted(gaps), key=gaps.get)
        assert model.predict(d["text"]) == (best, 1 - gaps[best] / (50 * len(own)))


def test_awkward(spark):
    for df in (awkward(spark), clashing(spark)):
        rows = langid.identify(df).collect()
        assert len(rows) == len(AWKWARD)
        for r in rows:
            texts = [x[1] for x in AWKWARD if x[0] == r["doc_id"]]
            assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[0] or ""))
    assert langid.identify(awkward(spark).limit(0)).collect() == []
    no_lang = awkward(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in langid.identify(no_lang).collect()} == {"und"}


ENGLISH = ["the cat sat on the mat and the dog lay by the door", "there is nothing that the other one would have said of it", "this was then the end of that thing in the house"]


def test_letters_of_all_alphabets_are_their_own(spark):
    """Characters that differ from Latin letters by a multiple of some power of two or base are no Latin letters."""
    model = langid.Profiles([("en", int(c), k) for k, c in enumerate(langid.top_ranked(*langid.ngram_counts(" ".join(ENGLISH)), 400))], 400)
    for text in ("偟偓偐", "саt оn thе".replace("t", "т").replace("n", "п").replace("h", "н"), "ἀβγδ", "".join(chr(ord(c) + 1023 * 7) for c in "thecat"), "".join(chr(ord(c) + 0x10000) for c in "thecat")):
        if any(c.isalpha() for c in text):
            assert model.predict(text)[1] == 0.0, text
    codes = [int(c) for t in ("the", "偟偓偐", "τηε", "тхе") for c in langid.ngram_counts(t)[0]]
    assert len(codes) == len(set(codes))


def test_texts_in_no_learned_language_are_left_out(spark):
    rng = random.Random(4)
    noise = ["".join(rng.choice("bcdfghjklmnpqrstvwxz   ") for _ in range(400)) for _ in range(5)]
    rows = [(i, ENGLISH[i % 3] + f" and so on {i}", "en") for i in range(200)] + [(1000, "საქართველო ქვეყანაა " * 5, None), (1001, None, "en"), (1002, "12 34", "en"), (None, ENGLISH[0], None)]
    rows += [(2000 + i, t, None) for i, t in enumerate(noise)]
    df = spark.createDataFrame([r + ("x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    kept = langid.identified(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(200), None}
    assert langid.identified(df.limit(0)).collect() == []
    assert langid.identified(df.withColumn("lang", F.lit(None).cast("string"))).collect() == []


def test_floor_is_a_share_of_what_nearly_all_reach(spark):
    rows = [("en", "en", 0.5 + i / 2000) for i in range(1000)] + [("en", "en", 0.01), (None, "en", 0.0), ("en", "und", 0.0)]
    df = spark.createDataFrame(rows, "lang string, lang_pred string, score double")
    assert langid.score_floor(df) == pytest.approx(0.6 * 0.5, abs=1e-3)
    assert langid.score_floor(df.limit(0)) == 0.0
