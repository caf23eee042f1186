"""Token counts of whole documents, huge ones by overlapping chunks.

A huge document is encoded in chunks that overlap. Both encodings of an overlap have offsets; they
are spliced at a boundary that both have and that is proven stable: a character that is not white
space followed by a space or line feed, where the pre-tokenizer always starts a new piece
whatever stands before or after. Where an overlap has none, it is widened until it has one or the
document ends.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._common import row_groups, text_buffer
from quarry.llm.bpe import ByteBpe, load

CHUNK_CHARS, OVERLAP_CHARS = 32_768, 256
BOUNDARY = re.compile("[!-~][ \n]")   # where a boundary is stable, if tokens of both chunks end there


def _offsets(bpe: ByteBpe, text: str) -> tuple[np.ndarray, bytes]:
    """Byte offset after each token, and the text's bytes."""
    ids = bpe.ids(text)
    lengths = bpe.lengths
    return np.cumsum([lengths[i] for i in ids]), text.encode()


def stable_boundary(left_ends: np.ndarray, right_ends: np.ndarray, left: bytes, overlap: int) -> tuple[int, int, int] | None:
    """(tokens of the left chunk, tokens of the right one to skip, bytes of the overlap before it) at the last
    common stable boundary of the ``overlap`` bytes that end the left chunk and begin the right one."""
    start = len(left) - overlap
    common = np.intersect1d(left_ends[left_ends > start] - start, right_ends[right_ends < overlap])
    for p in common[::-1].tolist():
        before, after = left[start + p - 1], left[start + p]
        if 0x21 <= before <= 0x7E and after in b" \n":
            return int(np.searchsorted(left_ends, start + p, "right")), int(np.searchsorted(right_ends, p, "right")), p
    return None


def count_spliced(bpe: ByteBpe, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text`` from overlapping chunks."""
    total, skip = 0, 0   # skip: tokens of the present chunk that are counted already
    spliced, hi = 0, min(len(text), chunk)   # where the last splice was, and where the present chunk ends
    ends, raw = _offsets(bpe, text[:hi])
    wide = overlap
    while hi < len(text):
        start = max(spliced, hi - wide)
        if BOUNDARY.search(text, start, hi):
            stop = min(len(text), hi + chunk)
            next_ends, next_raw = _offsets(bpe, text[start:stop])
            found = stable_boundary(ends, next_ends, raw, len(text[start:hi].encode()))
            if found:
                total += found[0] - skip
                spliced, hi, skip, ends, raw = start + len(next_raw[: found[2]].decode()), stop, found[1], next_ends, next_raw
                wide = overlap
                continue
        if start > spliced:
            wide *= 2
            continue
        # no boundary since the last splice: the chunk grows past the next one
        more = BOUNDARY.search(text, hi - 1)
        hi = min(len(text), more.end() + overlap) if more else len(text)
        ends, raw = _offsets(bpe, text[spliced:hi])
        skip, wide = 0, overlap
    return total + len(ends) - skip


def token_counts(docs: DataFrame, limit: int, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each whole text; special strings in a text count as
    one token, as by the library's default. Null text is empty: 0 bytes, 0 tokens. Repeated rows
    and other columns are left as they are; an empty table gives none."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        bpe = load(path)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in row_groups(offsets):
                block, o = data[offsets[lo]: offsets[hi]].tobytes(), (offsets[lo: hi + 1] - offsets[lo]).tolist()
                counts = []
                for x, y in zip(o, o[1:]):
                    text = block[x:y].decode("utf-8")
                    counts.append(len(bpe.ids(text)) if len(text) <= chunk else count_spliced(bpe, text, chunk, overlap))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets[lo: hi + 1]), pa.int64()), pa.array(counts, pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])
    counted = (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
               .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
