"""Lexical retrieval packing: sequences filled with BM25 neighbours.

Documents are tokenized once and dealt into shards of like documents. A shard is an inverted index
with BM25 weights (document frequencies over all documents). The first unused document seeds a
window; its best unused neighbours follow until the window is full, the last one being cut.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm._common import materialize, row_groups, text_buffer

WINDOW = 4096
SHARD_TOKENS = 1_000_000
K1, B = 1.2, 0.75
END_ID = 2
MEMO_ENTRIES, MEMO_CHARS = 250_000, 48
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class _Memo(dict):
    """Remembers the results of a function for short strings, a bounded number of them."""

    def __init__(self, of):
        self.of = of

    def __missing__(self, key: str) -> bytes:
        out = self.of(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[key] = out
        return out


class WordBpe:
    """A BPE vocabulary with word ends, lower case, and white space dropped (tokenizers JSON).

    No token spans white space, so stretches of words are encoded by themselves. Words of ASCII and
    Latin-1 letters, digits and signs are lower-cased and cut into pieces byte-wise: the last
    byte of a piece is swapped for one that such texts leave free (``LAST``), so a piece ends where
    one of those stands and the vocabulary's merges apply to the bytes as they are. Any other word
    is left to the library and remembered.
    """

    #: Signs of ASCII, in order; the last byte of a run of them becomes its place here.
    SIGNS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
    #: Second bytes (after C3) of the Latin-1 small letters, but the last one.
    SMALL = bytes([0x9F, *(c for c in range(0xA0, 0xBF) if c != 0xB7)])
    #: What may stand inside a piece, and for each byte that may end one, its form as the last.
    INNER = frozenset(bytes(range(0x61, 0x7B)) + SIGNS + b"\xc3" + SMALL)
    LAST = {**{c: c - 0x20 for c in range(0x61, 0x7B)}, **{c: i for i, c in enumerate(SIGNS)}, **{c: c for c in range(0x30, 0x3A)},
            **{c: c - 0x20 for c in SMALL[1:]}, 0x9F: 0x97}
    LOWER = bytes(c + 0x20 if 0x41 <= c <= 0x5A or 0x80 <= c <= 0x9E else 0x20 if c in b"\t\n\r" else c for c in range(256))
    #: Bytes of such texts before they are lower-cased (no multiplication sign, which is C3 97).
    PLAIN = b"\t\n\r" + bytes(range(0x20, 0x7F)) + b"\xc3" + SMALL + bytes(c - 0x20 for c in SMALL[1:])
    #: A word for the library: one with another character, or that may hold a special token.
    ODD = re.compile(r"[^\t\n\r -~À-ÖØ-Þß-öø-þ]|<\|")
    CONTRACTION = re.compile(rb"(?<![!-/:-@\[-`{-~])'(?:s|t|re|ve|m|ll|d)")

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        top = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.size = top + 1
        from quarry.llm.bpe import _byte_of_char
        to_byte = _byte_of_char()

        def form(token: str) -> bytes | None:
            """The token as it stands in a text made ready, None if it can't stand there."""
            ends = token.endswith(end)
            raw = bytes(to_byte[c] for c in (token[: -len(end)] if ends else token))
            inner = raw[:-1] if ends else raw
            if not raw or not self.INNER.issuperset(inner) or (ends and raw[-1] not in self.LAST):
                return None
            return inner + bytes([self.LAST[raw[-1]]]) if ends else raw

        char = {b: c for c, b in to_byte.items()}
        ranks = {bytes([b]): b for b in range(256)}
        ids = [vocab[char[b]] for b in range(256)]
        for b, as_last in self.LAST.items():
            ids[as_last] = vocab[char[b] + end]
        for merge in spec["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            token = form(left + right)
            if token is not None and token not in ranks:
                ranks[token] = len(ids)
                ids.append(vocab[left + right])
        self.id_of_rank = np.array(ids, self.dtype)
        stops = r"A-Z0-9\x00-\x1f\u00c0-\u00de"
        # no text that comes here holds the special token; it lets the ids arrive as a buffer
        encoding = tiktoken.Encoding("word-bpe", pat_str=f"[^ {stops}]*[{stops}]", mergeable_ranks=ranks, special_tokens={"<|": len(ids)})
        self.merge = encoding._core_bpe.encode_to_tiktoken_buffer
        letters = {*range(0x61, 0x7B), 0xC3, *self.SMALL}
        self.kind = bytes(1 if c in letters else 2 if 0x30 <= c <= 0x39 else 3 if c in self.SIGNS else 0 for c in range(256))
        self.last = bytes(self.LAST.get(c, c) for c in range(256))
        self.memo = _Memo(self._encode_word)

    def _encode_plain(self, raw: bytes) -> bytes:
        """Ids of a text of PLAIN bytes alone, without ``<|``."""
        raw = raw.translate(self.LOWER)
        kind = np.frombuffer(raw.translate(self.kind), np.uint8)  # white space, letter, digit, sign
        stop = kind > 0
        stop[:-1] &= (kind[:-1] != kind[1:]) | (kind[:-1] == 2)
        if b"'" in raw:
            for m in self.CONTRACTION.finditer(raw):
                stop[m.start()], stop[m.end() - 1] = False, True
        ready = np.where(stop, np.frombuffer(raw.translate(self.last), np.uint8), np.frombuffer(raw, np.uint8)).tobytes().decode()
        return self.id_of_rank[np.frombuffer(self.merge(ready, set()), np.uint32)].tobytes()

    def _encode_word(self, word: str) -> bytes:
        return np.array(self.library.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        raw = text.encode()
        if "<|" not in text and not raw.translate(None, self.PLAIN):
            return self._encode_plain(raw)
        out: list[bytes] = []
        plain: list[str] = []
        for word in text.replace("\n", " ").split(" "):
            if self.ODD.search(word):
                if plain:
                    out.append(self._encode_plain(" ".join(plain).encode()))
                    plain.clear()
                out.append(self.memo[word])
            elif word:
                plain.append(word)
        if plain:
            out.append(self._encode_plain(" ".join(plain).encode()))
        return b"".join(out)


@lru_cache(2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def tokenize(docs: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, ids): ids of the whole text and the end id; ``key`` is the MinHash of the set of
    ids, so that documents with much in common sort together."""
    def run(batches):
        bpe = load(path)
        end = np.array([END_ID], bpe.dtype).tobytes()
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in row_groups(offsets):
                block, o = data[offsets[lo]: offsets[hi]].tobytes(), (offsets[lo: hi + 1] - offsets[lo]).tolist()
                ids = [bpe.encode(block[x:y].decode("utf-8")) + end for x, y in zip(o, o[1:])]
                keys = [int(((np.frombuffer(x, bpe.dtype).astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)).min()) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(keys, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "key", "ids"])
    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, key long, ids binary"))


def document_frequencies(tokens: DataFrame, path: str) -> tuple[np.ndarray, int, int]:
    """(documents holding each id, documents, tokens) over all documents. Every task adds up its own
    counts; the driver gets one row per vocabulary id."""
    def run(batches):
        bpe = load(path)
        df = np.zeros(bpe.size, np.int64)
        n = total = 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = np.frombuffer(raw, bpe.dtype)
                df[np.unique(ids)] += 1
                n, total = n + 1, total + len(ids)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([used, [-1, -2]])), pa.array(np.concatenate([df[used], [n, total]]))], names=["id", "n"])
    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    got = {r["id"]: r["n"] for r in rows}
    df = np.zeros(load(path).size, np.int64)
    for i, n in got.items():
        if i >= 0:
            df[i] = n
    return df, got.get(-1, 0), got.get(-2, 0)


class _Item:
    """What is left of a document: ids from ``start`` on."""
    __slots__ = ("doc_id", "doc_tokens", "ids", "start")

    def __init__(self, doc_id, doc_tokens, ids, start):
        self.doc_id, self.doc_tokens, self.ids, self.start = doc_id, doc_tokens, ids, start

    def take(self, n: int) -> tuple:
        piece = (self.doc_id, self.start, self.ids[:n], self.doc_tokens)
        self.ids, self.start = self.ids[n:], self.start + n
        return piece


class Bm25Shard:
    """Inverted index of a shard: for each id its documents and BM25 weights."""

    def __init__(self, items: list[_Item], idf: np.ndarray, mean_length: float):
        terms, docs, weights = [], [], []
        self.query: list[np.ndarray] = []
        for d, item in enumerate(items):
            t, tf = np.unique(item.ids, return_counts=True)
            self.query.append(t)
            terms.append(t)
            docs.append(np.full(len(t), d))
            norm = K1 * (1 - B + B * len(item.ids) / mean_length)
            weights.append((idf[t] * tf * (K1 + 1) / (tf + norm)))
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = np.concatenate(docs)[order], np.concatenate(weights)[order]
        self.first = np.zeros(len(idf) + 1, np.int64)
        np.cumsum(np.bincount(term, minlength=len(idf)), out=self.first[1:])
        self.size = len(items)

    def scores(self, seed: int) -> np.ndarray:
        t = self.query[seed]
        first = self.first[t]
        n = self.first[t + np.int64(1)] - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(self.docs[at], self.weights[at], minlength=self.size)


def fill_windows(items: list[_Item], idf: np.ndarray, mean_length: float, window: int = WINDOW):
    """Yield full windows (lists of pieces); return the items that are left, less than a window."""
    for item in items:
        while len(item.ids) >= window:
            yield [item.take(window)]
    items = [x for x in items if len(x.ids)]
    left = sum(len(x.ids) for x in items)
    if left < window:
        return items
    shard = Bm25Shard(items, idf, mean_length)
    unused = np.ones(len(items), bool)
    for seed, item in enumerate(items):
        if not unused[seed] or not len(item.ids):
            continue
        if left < window:
            break
        unused[seed] = False
        scores = np.where(unused, shard.scores(seed), -1.0)
        pieces, space = [item.take(len(item.ids))], window
        space -= len(pieces[0][2])
        some = min(32, len(items))
        top = np.argpartition(-scores, some - 1)[:some]
        order = top[np.lexsort((top, -scores[top]))]
        whole = False
        k = 0
        while space:
            if k == len(order):
                if whole:
                    break
                order, whole, k = np.lexsort((np.arange(len(items)), -scores)), True, 0
            other = int(order[k])
            k += 1
            if not unused[other]:
                continue
            n = min(space, len(items[other].ids))
            pieces.append(items[other].take(n))
            space -= n
            if not len(items[other].ids):
                unused[other] = False
        left -= window
        yield pieces
    return [x for x in items if len(x.ids)]


def _pack(path: str, stats, window: int, shard_tokens: int):
    def run(batches):
        df, n, total = stats.value
        dtype = load(path).dtype
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        mean = max(total / max(n, 1), 1.0)
        base, count = TaskContext.get().partitionId() << 40, 0
        rows: list[tuple] = []

        def emit(pieces):
            nonlocal count
            offset = 0
            for doc_id, start, ids, doc_tokens in pieces:
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), doc_tokens, base + count, offset))
                offset += len(ids)
            count += 1

        def batch_of(got):
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in got], pa.int64()) for j in range(7)],
                                              names=[x.split()[0] for x in PIECES.split(", ")])

        def windows(items):
            rest = yield from fill_windows(items, idf, mean, window)
            return rest

        def drain(items):
            gen = windows(items)
            while True:
                try:
                    emit(next(gen))
                except StopIteration as end:
                    return end.value

        held, size = [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(raw, dtype)
                held.append(_Item(doc_id, len(ids), ids, 0))
                size += len(ids)
                if size >= shard_tokens:
                    held = drain(held)
                    size = sum(len(x.ids) for x in held)
                if len(rows) >= 20_000:
                    yield batch_of(rows)
                    rows.clear()
        held = drain(held)
        # the partition's last ids: sequences whose length is a power of two need no padding
        left = sum(len(x.ids) for x in held)
        while left:
            space = 1 << (left.bit_length() - 1)
            left -= space
            pieces = []
            while space:
                n = min(space, len(held[0].ids))
                pieces.append(held[0].take(n))
                space -= n
                if not len(held[0].ids):
                    held.pop(0)
            emit(pieces)
        if rows:
            yield batch_of(rows)
    return run


def pack(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces (``PIECES``) of all documents in sequences of at most ``window`` tokens.

    Defined cases: a null or empty text is the end id alone; a document longer than a window fills
    whole windows first; repeated rows are packed as often as they occur; null ids are kept; an
    empty table gives none. Every partition's last ids become sequences of lengths that are powers
    of two, so nothing is padded.

    Scale: tokenized once into a shared table; statistics are one row per vocabulary id; documents
    move once, range-partitioned by (MinHash key, id) so that a key shared by any number of rows is
    split; a shard of ``shard_tokens`` is all that a task holds.
    """
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    tokens = materialize(tokenize(docs, path, id_col, text_col), "tokens")
    stats = spark.sparkContext.broadcast(document_frequencies(tokens, path))
    dealt = tokens.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id", "ids").select("doc_id", "ids")
    return dealt.mapInArrow(_pack(path, stats, window, shard_tokens), PIECES)
