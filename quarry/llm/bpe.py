"""Byte-pair encoding by forced boundaries.

A pair of bytes that occurs inside no vocabulary token can never be merged across, so a text may
be cut there and the fragments encoded by themselves. The cuts are found by a table lookup over
the whole Arrow buffer; a fragment's ids are remembered, so a frequent one is encoded once per
worker.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._common import row_groups, text_buffer

MEMO_ENTRIES, MEMO_BYTES = 400_000, 64

#: Runs of white space that the pre-tokenizer's pattern, which looks ahead and steps back, does not get to see.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes stand
    for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE vocabulary file (tokenizers JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = _byte_of_char()
        self.ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text in self.special:
            self.ranks.pop(text.encode(), None)
        self.tokens = {i: b for b, i in self.ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.lengths = {i: len(b) for i, b in self.tokens.items()}
        self.encoding = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks,
                                          special_tokens=self.special)
        self.memo: dict[bytes, bytes] = {}
        self.cut_table, self.wide_table = self._cut_table(), np.zeros((256, 256), bool)
        for pair in self.WIDE_SPACE:
            self.wide_table[pair] = True
        # a cut would tear a special string apart or change what precedes it: such texts are split there first
        self.special_bytes = [t.encode() for t in self.special]

    def _cut_table(self) -> np.ndarray:
        """forced[b1, b2]: no token holds the pair, and a cut there leaves the pre-tokenizer's pieces
        as they are. The latter needs b2 to begin a character, b1 not to end white space (runs of
        white space look ahead), and b2 not to be an apostrophe after punctuation (contractions)."""
        forced = np.ones((256, 256), bool)
        for token in self.ranks:
            if len(token) > 1:
                t = np.frombuffer(token, np.uint8)
                forced[t[:-1], t[1:]] = False
        forced[:, 0x80:0xC0] = False
        forced[[*range(0x09, 0x0E), *range(0x1C, 0x21)], :] = False
        word = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]
        ok = np.zeros(256, bool)
        ok[word] = True
        forced[~ok, 0x27] = False
        return forced

    #: Last two bytes of the white-space characters beyond ASCII.
    WIDE_SPACE = {(0xC2, 0x85), (0xC2, 0xA0), (0x9A, 0x80), *((0x80, x) for x in range(0x80, 0x8B)),
                  (0x80, 0xA8), (0x80, 0xA9), (0x80, 0xAF), (0x81, 0x9F)}

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions at which the bytes may be cut."""
        at = np.flatnonzero(self.cut_table[data[:-1], data[1:]]) + 1
        return at[~self.wide_table[data[np.maximum(at - 2, 0)], data[at - 1]]]

    def plain_ids(self, text: str) -> list[int]:
        """Ids of a text whose special strings are ordinary text. Of a run of white space before another
        character the pattern takes all but the last one as one piece, and the last one goes with what
        follows; at the end of a text the run is one piece. Long runs are cut by that rule."""
        out, at = [], 0
        for m in LONG_SPACE.finditer(text):
            out += self.encoding.encode_ordinary(text[at: m.start()])
            at = m.end() - (m.end() < len(text))
            out += self.encoding._encode_single_piece(text[m.start(): at])
        return out + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text)

    def ids(self, text: str) -> list[int]:
        """Ids of a text; special strings become theirs."""
        if not LONG_SPACE.search(text):
            return self.encoding.encode(text, allowed_special="all")
        out = []
        for part in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if self.special else [text]:
            out += [self.special[part]] if part in self.special else self.plain_ids(part)
        return out

    def _encode_fragment(self, fragment: bytes) -> bytes:
        ids = np.array(self.plain_ids(fragment.decode("utf-8")), np.uint32).astype("<u4").tobytes()
        if len(fragment) <= MEMO_BYTES:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            self.memo[fragment] = ids
        return ids

    def _encode_plain(self, raw: bytes) -> bytes:
        if not raw:
            return b""
        at = [0, *self.cuts(np.frombuffer(raw, np.uint8)).tolist(), len(raw)]
        get, miss = self.memo.get, self._encode_fragment
        out = []
        for lo, hi in zip(at, at[1:]):
            fragment = raw[lo:hi]
            ids = get(fragment)
            out.append(miss(fragment) if ids is None else ids)
        return b"".join(out)

    def encode(self, raw: bytes) -> bytes:
        """Ids of UTF-8 text as little-endian unsigned 32-bit integers. Special strings inside the
        text become their ids, as the library does by default."""
        for special in self.special_bytes:
            if special in raw:
                one = np.array([self.special[special.decode()]], "<u4").tobytes()
                return one.join(self.encode(part) for part in raw.split(special))
        return self._encode_plain(raw)

    def decode(self, ids: bytes) -> str:
        tokens = self.tokens
        return b"".join([tokens.get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(4)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


ENCODED = "doc_id long, n_tokens long, ids binary"


def _raws(batch: pa.RecordBatch):
    data, offsets = text_buffer(batch.column(1))
    for lo, hi in row_groups(offsets):
        block = data[offsets[lo]: offsets[hi]].tobytes()
        o = (offsets[lo: hi + 1] - offsets[lo]).tolist()
        yield lo, [block[x:y] for x, y in zip(o, o[1:])]


def encode_documents(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of each whole text, little-endian unsigned 32-bit.

    ``vocabulary`` is the path of a byte-level BPE file that every executor has. Null text is
    empty and has no ids; ids, repeated rows and other columns of ``docs`` are left as they are.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        bpe = load(path)
        for batch in batches:
            for lo, raws in _raws(batch):
                ids = [bpe.encode(raw) for raw in raws]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(ids)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, ENCODED)


def decode_documents(encoded: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the text that ids stand for; null ids give null; unknown ids give nothing."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        bpe = load(path)
        for batch in batches:
            texts = [None if x is None else bpe.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return encoded.select(F.col(id_col).cast("long"), F.col(ids_col)).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes, decodes those ids again, and keeps
    the digests, all in one pass over the texts."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        bpe = load(path)
        for batch in batches:
            for lo, raws in _raws(batch):
                ids = [bpe.encode(raw) for raw in raws]
                back = [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(ids)), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array(back, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))

