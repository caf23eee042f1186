import zlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import langid, near_dedup, secrets
from tests.llm.data import AWKWARD, SCHEMA, SF01, table
from tests.llm.test_near_dedup import brute
from tests.llm.test_tokens import check_packing


def expected(rows):
    """(doc_id, text) of (doc_id, text, lang) that reach packing, by plain Python."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    counted = {}
    for i, t, lang in rows:
        if t is not None and lang is not None and i is not None and not held(i):
            counted.setdefault(lang, Counter()).update(dict(zip(*(x.tolist() for x in langid.ngram_counts(t)))))
    places = [(lang, code, k) for lang, n in counted.items() for k, (code, _) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0]))[:400])]
    model = langid.Profiles(places, 400)
    scored = [(i, t, lang, *model.predict(t)) for i, t, lang in rows]
    labelled = sorted(int(s * 1000) for _, _, lang, pred, s in scored if lang is not None and pred != "und")
    floor = 0.6 * labelled[int(0.001 * len(labelled))] / 1000 if labelled else 0
    texts = [(i, t) for i, t, _, pred, s in scored if pred != "und" and s >= floor]
    numbered = [(k, t) for k, (_, t) in enumerate(texts)]
    group = {k: c for k, _, c, _ in brute(numbered, 5)}
    best = {}
    for k, (i, _) in enumerate(texts):
        best[group[k]] = min(best.get(group[k], (True, 0, k)), (i is None, i or 0, k))
    return [(i, secrets.redact(t, secrets.scan_text(t)[1])) for k, (i, t) in enumerate(texts) if best[group[k]][2] == k]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "secret_scan", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_matches_brute_force(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = corpus_pipeline.run(spark, SF01).collect()
    check_packing(rows, expected([(d["doc_id"], d["text"], d["lang"]) for d in table("documents")]), library)


def test_stages_on_awkward_documents(spark):
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
    got = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert got == sorted(expected([r[:3] for r in AWKWARD]), key=repr)
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").collect() == []


def test_rows_that_share_an_id_go_only_if_linked(spark):
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    near = words(1).replace("w1x30", "other")
    rows = [(1, words(1)), (1, words(2)), (2, words(2)), (1, near), (1, words(1)), (None, words(3)), (None, words(4)), (7, words(4)), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    got = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    # either text of the first group may stay: all its rows have the id 1
    assert [x for x in got if x[1] not in (words(1), near)] == [(0, words(3)), (1, words(2)), (7, words(4)), (8, "")]
    assert len(got) == 5 and got[1][0] == 1


def test_language_stage_rejects_by_score(spark):
    docs = spark.createDataFrame([(i, f"the cat and the dog were in the house of the other one {i}", "en", "s", 5) for i in range(50)]
                                 + [(99, "საქართველო ქვეყანაა " * 9, None, "s", 5)], SCHEMA)
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()} == set(range(50))


def test_texts_that_stay_are_not_shuffled(spark):
    """Only rows marked by the bit map go to the join with the dropped ones; scratch tables are zstd."""
    words = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(60)]
    docs = spark.createDataFrame([(i, words[i % 50], "en", "a", 1) for i in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    sides = plan[plan.index("Union"):].split("Join LeftAnti")
    assert len(sides) == 2 and "Filter NOT pythonUDF" in sides[0] and "Filter pythonUDF" in sides[1]   # one side is not joined, the other filtered first
    assert sorted(r.doc_id for r in out.collect()) == list(range(50))
    assert all(".zstd." in f for f in out.inputFiles())
    ids = spark.range(0, 1000).toDF("row")
    got = spark.range(0, 100_000).toDF("row").filter(near_dedup.perhaps_among(ids, "row"))
    assert got.filter("row < 1000").count() == 1000 and got.count() < 1100
