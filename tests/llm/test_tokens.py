import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import bpe, packing, token_counts
from quarry.llm.queries import op5_bpe, op6_token_counts, op8_packing
from tests.llm.data import AWKWARD, SF01, awkward, clashing, table


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def encoded(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())


def key(rows):
    return sorted(rows, key=repr)


def test_bpe_query_matches_library(spark, byte_library):
    got = key(tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) for r in op5_bpe(spark, SF01).collect())
    assert got == key((d["doc_id"], *encoded(byte_library, d["text"])) for d in table("documents"))


def test_bpe_awkward(spark, byte_library):
    want = key((r[0], *encoded(byte_library, r[1])) for r in AWKWARD)
    for df in (awkward(spark), clashing(spark)):
        assert key(tuple(r) for r in bpe.digests(df).collect()) == want
    assert bpe.digests(awkward(spark).limit(0)).collect() == []
    back = bpe.decode_documents(bpe.encode_documents(awkward(spark)))
    assert key(tuple(r) for r in back.collect()) == key((r[0], r[1] or "") for r in AWKWARD)


ALPHABET = list("abcXYZ09 \n\t'!.,\"-_") + ["  ", "'s", "'ll", "é", "ß", " ", " ", "　", "\x1c", "\x85", "漢", "😀", "́", "½", "٣", "<|endoftext|>", "qx", "zzqj", " the", "\r\n"]


def fuzz(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_forced_boundaries_fuzz(byte_library):
    own = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    for text in fuzz(4000, 1):
        ids = byte_library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == ids, repr(text)
        assert own.decode(own.encode(text.encode())) == byte_library.decode(ids, skip_special_tokens=False)


LONG = {"inside": lambda c, n: "a" + c * n + "x", "after a space": lambda c, n: "a " + c * n + " x", "at the end": lambda c, n: "a" + c * n, "alone": lambda c, n: c * n,
        "before a special string": lambda c, n: c * n + "<|endoftext|>" + c * n + "'s", "twice": lambda c, n: c * n + "é" + c * n + "."}


@pytest.mark.parametrize("where", LONG)
@pytest.mark.parametrize("char", [" ", "\t", "\n", "\u00a0", "\r\n"])
def test_long_white_space(byte_library, char, where):
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    for n in (4095, 4096, 4097, 300_000):
        text = LONG[where](char, n)
        ids = byte_library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(vocabulary.encode(text.encode()), "<u4").tolist() == ids
        assert vocabulary.ids(text) == ids
        if n == 4096:
            assert token_counts.count_spliced(vocabulary, text, 1000, 16) == len(ids)


def test_two_million_white_spaces_through_spark(spark, byte_library, word_library):
    texts = ["a" + c * 2_000_000 + "x" for c in (" ", "\t", "\n", "\u00a0")] + [" " * 2_000_000, "z" * 1_000_000, "!" * 1_000_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = [encoded(byte_library, t) for t in texts[:5]]
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(df).collect()}
    assert [got[i] for i in range(5)] == want
    assert all(got[i][2] == sha(t.encode()) for i, t in enumerate(texts))   # the library takes minutes for the last two
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(df, 512).collect()}
    assert counts == {i: g[0] for i, g in got.items()}
    check_packing(packing.pack(df.filter("doc_id < 5")).collect(), list(enumerate(texts[:5])), word_library)


def test_decoding_of_broken_characters(byte_library):
    own = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(256), rng.randrange(50257)]) for _ in range(8)]
        assert own.decode(np.array(ids, "<u4").tobytes()) == byte_library.decode(ids, skip_special_tokens=False)


def test_token_counts_query(spark, byte_library):
    got = key(tuple(r) for r in op6_token_counts(spark, SF01).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())
    n = lambda t: len(byte_library.encode(t or "", add_special_tokens=False).ids)
    assert got == key((d["doc_id"], len((d["text"] or "").encode()), n(d["text"]), n(d["text"]) > 512) for d in table("documents"))


def test_token_counts_awkward(spark, byte_library):
    n = {r[1]: len(byte_library.encode(r[1] or "", add_special_tokens=False).ids) for r in AWKWARD}
    want = key((r[0], len((r[1] or "").encode()), n[r[1]], n[r[1]] > 3) for r in AWKWARD)
    for df in (awkward(spark), clashing(spark)):
        for chunk, overlap in ((32_768, 256), (1000, 8)):
            assert key(tuple(r) for r in token_counts.token_counts(df, 3, chunk=chunk, overlap=overlap).collect()) == want
    assert token_counts.token_counts(awkward(spark).limit(0), 3).collect() == []


def test_splicing_fuzz(byte_library):
    own = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    for text in fuzz(600, 2):
        want = len(byte_library.encode(text, add_special_tokens=False).ids)
        for chunk, overlap in ((7, 2), (12, 6), (20, 3)):
            assert token_counts.count_spliced(own, text, chunk, overlap) == want, repr(text)


def test_word_vocabulary_fuzz(word_library):
    own = packing.load(public_tokenizers.path("word_bpe_49k.json"))
    texts = fuzz(3000, 3) + ["Straße ÀÉÎ don't I'LL x1y2 ***!!! '", "İI ıi ŉ ǅ ǆ ÿŸ"] + [r[1] or "" for r in AWKWARD if len(r[1] or "") < 500]
    for text in texts:
        assert np.frombuffer(own.encode(text), own.dtype).tolist() == word_library.encode(text, add_special_tokens=False).ids, repr(text)


def check_packing(rows, docs, library, little=0.02):
    """Every id of every document lies in one piece; sequences are gapless and hold at most 4096."""
    ids = {}
    for i, t in docs:
        ids.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        pieces.setdefault(r["doc_id"], []).append(r)
    padded = used = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 4096
        used += at
        padded += 0 if at & (at - 1) == 0 else 4096 - at
    assert padded <= little * used
    assert set(pieces) == set(ids)
    for i, texts in ids.items():
        if len(texts) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(texts[0])
                assert r["ids_crc32"] == zlib.crc32(np.array(texts[0][at:at + r["length"]], "<u4").tobytes())
                at += r["length"]
            assert at == len(texts[0])
        else:
            assert sum(r["length"] for r in pieces[i]) == sum(map(len, texts))


def test_packing_query(spark, word_library):
    rows = op8_packing(spark, SF01).collect()
    check_packing(rows, [(d["doc_id"], d["text"]) for d in table("documents")], word_library)


def test_packing_awkward(spark, word_library):
    for df in (awkward(spark), clashing(spark)):
        check_packing(packing.pack(df, shard_tokens=20_000).collect(), [(r[0], r[1]) for r in AWKWARD], word_library)
    assert packing.pack(awkward(spark).limit(0)).collect() == []


def test_neighbours_share_windows():
    """Windows of one topic: BM25 prefers documents on the seed's topic."""
    rng = np.random.default_rng(0)
    items = []
    for d in range(120):
        topic = d % 3
        items.append(packing._Item(d, 500, (rng.integers(0, 60, 500) + 100 * topic).astype(np.uint16), 0))
    df = np.zeros(400, np.int64)
    for x in items:
        df[np.unique(x.ids)] += 1
    idf = np.log1p((120 - df + 0.5) / (df + 0.5))
    windows = list(packing.fill_windows(items, idf, 500.0))
    pure = sum(len({p[0] % 3 for p in w}) == 1 for w in windows)
    assert len(windows) == 120 * 500 // 4096 and pure >= len(windows) - 4


def test_bm25_scores_match_formula():
    rng = np.random.default_rng(1)
    items = [packing._Item(d, 50, rng.integers(0, 40, rng.integers(5, 50)).astype(np.uint16), 0) for d in range(30)]
    idf = rng.random(40)
    shard = packing.Bm25Shard(items, idf, 25.0)
    got = shard.scores(3)
    for d, x in enumerate(items):
        want = 0.0
        for t in set(items[3].ids.tolist()):
            tf = int((x.ids == t).sum())
            want += idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(x.ids) / 25.0))
        assert abs(got[d] - want) < 1e-4
