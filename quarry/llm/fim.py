"""Fill-in-middle transformation by displacement scatter.

A batch of texts is one byte buffer. The cuts of every document say by how much each of its three
segments moves; the differences between neighbouring segments' moves are put where a segment
begins, their running sum is every byte's displacement, and one scatter writes all outputs. The
inverse reads the segments off an output's marks and gathers by the same displacements.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._common import _SPACE, row_groups, text_buffer

# fixed values: the marks before prefix, suffix and middle
MARKS = (b"<P>", b"<S>", b"<M>")
FIM_PERCENT, SPM_PERCENT, SEED = 50, 80, "42"
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
SLICE = 1 << 20   # bytes whose displacements are held at a time


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte after each unit (white space and the word behind it; white space that ends a text is a
    unit of its own), all documents in a row, and the number of the first unit of each document."""
    inside = ~_SPACE[data]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    full = np.diff(offsets) > 0
    ends[offsets[1:][full] - 1] = True    # a text's last byte ends its last unit, be it a word or white space
    at = np.flatnonzero(ends) + 1
    return at, np.searchsorted(at, offsets, "right")


def seeds(doc_id: int | None, seed: str = SEED) -> tuple[int, int, int, int]:
    """Four unsigned integers drawn from the id; a null id counts as empty text."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[i: i + 8], 16) for i in (0, 8, 16, 24))


def displaced(starts: np.ndarray, sizes: np.ndarray, forms: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of (prefix, middle, suffix) ``sizes`` that start at ``starts`` and whose outputs
    start at ``base``: where segments begin, by how much each moves, and where the marks go."""
    p, m, s = sizes.T
    mark = len(MARKS[0])
    to_p = np.select([forms == PSM, forms == SPM], [base + mark, base + 2 * mark + s], base)
    to_s = np.select([forms == PSM, forms == SPM], [base + 2 * mark + p, base + mark], base + p + m)
    to_m = np.where(forms == PLAIN, base + p, base + 3 * mark + p + s)
    begin = np.stack([starts, starts + p, starts + p + m], 1)
    return begin, np.stack([to_p, to_m, to_s], 1) - begin, np.stack([to_p, to_s, to_m], 1) - mark


def displacements(begin: np.ndarray, moves: np.ndarray, n: int):
    """(first byte, displacement of every byte) slice by slice, from the difference array."""
    begin, moves = begin.ravel(), moves.ravel()
    steps = np.diff(moves, prepend=0)
    held = 0
    for lo in range(0, n, SLICE):
        hi = min(n, lo + SLICE)
        here = slice(*np.searchsorted(begin, (lo, hi)))
        delta = np.bincount(begin[here] - lo, steps[here], hi - lo).astype(np.int64) if here.start < here.stop else np.zeros(hi - lo, np.int64)
        delta[0] += held
        shift = np.cumsum(delta)
        held = int(shift[-1])
        yield lo, shift


def code_points(data: np.ndarray, lo: int, hi: int) -> int:
    return int(np.count_nonzero((data[lo:hi] & 0xC0) != 0x80))


def transform_batch(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT):
    """Outputs of a batch of texts: (bytes, offsets, forms, units, sizes of prefix, middle, suffix)."""
    starts, length = offsets[:-1], np.diff(offsets)
    ends, first = unit_ends(data, offsets)
    units = np.diff(first)
    low, high = np.sort(draws[:, :2] % (units + 1)[:, None], axis=1).T
    where = np.concatenate([ends, [0]])   # units of 0: the start of the text, not an end
    cut = lambda k: np.where(k > 0, where[np.maximum(first[:-1] + k - 1, 0)], starts)
    sizes = np.stack([cut(low) - starts, cut(high) - cut(low), offsets[1:] - cut(high)], 1)
    raw = data.tobytes()
    marked = np.zeros(len(length), bool)
    if any(mark in raw for mark in MARKS):
        marked = np.array([any(raw.find(mark, a, b) >= 0 for mark in MARKS) for a, b in zip(starts.tolist(), offsets[1:].tolist())], bool)
    forms = np.where((length == 0) | marked | (draws[:, 2] % 100 >= fim_percent), PLAIN, np.where(draws[:, 3] % 100 < spm_percent, SPM, PSM))
    marks = sum(map(len, MARKS))
    to = np.concatenate([[0], np.cumsum(length + np.where(forms == PLAIN, 0, marks))])
    begin, moves, mark_at = displaced(starts, sizes, forms, to[:-1])
    out = np.empty(to[-1], np.uint8)
    for lo, shift in displacements(begin, moves, len(data)):
        out[np.arange(lo, lo + len(shift)) + shift] = data[lo: lo + len(shift)]
    for k, mark in enumerate(MARKS):
        at = mark_at[forms != PLAIN, k]
        out[at[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    return out, to, forms, units, sizes


def restore_batch(out: np.ndarray, offsets: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind outputs, from the outputs and their forms alone: (bytes, offsets)."""
    raw, mark = out.tobytes(), len(MARKS[0])
    sizes = np.zeros((len(forms), 3), np.int64)
    for i, (form, a, b) in enumerate(zip(forms.tolist(), offsets[:-1].tolist(), offsets[1:].tolist())):
        if form == PLAIN:
            sizes[i, 0] = b - a
            continue
        first, second = (0, 1) if form == PSM else (1, 0)
        x = raw.index(MARKS[second], a + mark, b)
        y = raw.index(MARKS[2], x + mark, b)
        sizes[i, 2 * first], sizes[i, 2 * second], sizes[i, 1] = x - a - mark, y - x - mark, b - y - mark
    to = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
    begin, moves, _ = displaced(to[:-1], sizes, forms, offsets[:-1])
    text = np.empty(to[-1], np.uint8)
    for lo, shift in displacements(begin, moves, len(text)):
        text[lo: lo + len(shift)] = out[np.arange(lo, lo + len(shift)) + shift]
    return text, to


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    wide = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return wide.cast(pa.string())


TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: str = SEED,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each whole text.

    A text is cut between two of its ``n`` units, chosen by a hash of ``seed`` and id, into prefix,
    middle and suffix; ``fim_percent`` of the texts are rearranged, ``spm_percent`` of these suffix
    first. A text that is empty or holds a mark stays ``plain`` (sizes null). Null text is empty, a
    null id hashes as empty text; repeated rows and an empty table pass; other columns play no
    part. A row depends on nothing but itself, so a lost task is simply run again.
    """
    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            ids = batch.column(0).to_pylist()
            for lo, hi in row_groups(offsets):
                part, o = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
                draws = np.array([seeds(i, seed) for i in ids[lo:hi]], np.int64)
                out, to, forms, units, sizes = transform_batch(part, o, draws, fim_percent, spm_percent)
                plain = forms == PLAIN
                cuts = [(a, a + p, a + p + m) for a, (p, m, _) in zip(o[:-1].tolist(), sizes.tolist())]
                chars = [[0, 0] if x else [code_points(part, a, b), code_points(part, b, c)] for x, (a, b, c) in zip(plain.tolist(), cuts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(units, pa.int64()), pa.array([FORMS[f] for f in forms.tolist()], pa.string()),
                     *(pa.array([c[k] for c in chars], pa.int64(), mask=plain) for k in (0, 1)), _strings(out, to)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, TRANSFORMED)


def restore(transformed: DataFrame, output_col: str = "output", form_col: str = "form", text_out: str = "restored") -> DataFrame:
    """``transformed`` with ``text_out``, the text that its output and form stand for. A null output is
    empty text; a null or unknown form counts as plain."""
    others = [c for c in transformed.columns if c != text_out]
    kinds = dict(transformed.dtypes)
    quoted = ["`" + c.replace("`", "``") + "`" for c in others]
    schema = ", ".join(["__text string", *(f"__c{i} {kinds[c]}" for i, c in enumerate(others))])

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            codes = np.array([FORMS.index(f) if f in FORMS else PLAIN for f in batch.column(1).to_pylist()], np.int64)
            for lo, hi in row_groups(offsets):
                text, to = restore_batch(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], codes[lo:hi])
                yield pa.RecordBatch.from_arrays([_strings(text, to), *(c.slice(lo, hi - lo) for c in batch.columns[2:])],
                                                 names=["__text", *(f"__c{i}" for i in range(len(others)))])
    out = transformed.select(F.col(output_col).cast("string"), F.col(form_col).cast("string"),
                             *(F.col(q).alias(f"__c{i}") for i, q in enumerate(quoted))).mapInArrow(run, schema)
    return out.select(*(F.col(f"__c{i}").alias(c) for i, c in enumerate(others)), F.col("__text").alias(text_out))
