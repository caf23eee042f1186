"""Language identification by rank-order n-gram profiles (out-of-place distance)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._common import materialize, row_groups, text_buffer

PROFILE = 400     # n-grams of a profile: the most frequent ones of a language or document
MAX_N = 3
SLICE = 1 << 20   # code points counted at a time
UNDETERMINED = "und"
#: A text is in no learned language if it scores less than this share of what all but the worst labelled texts score.
FLOOR_SHARE, FLOOR_WORST, FLOOR_BINS = 0.6, 0.001, 1000


BASE = 0x110000   # an n-gram's code has a digit of this base for each symbol, and one for its size before them


@lru_cache(1)
def _symbols() -> np.ndarray:
    """For every code point its symbol: the lower-cased letter, 0 for anything else."""
    symbol = np.zeros(BASE, np.int64)
    for c in range(BASE):
        ch = chr(c)
        if ch.isalpha():
            symbol[c] = ord(ch.lower()[0])
    return symbol


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1- to 3-grams of a text. Anything but letters separates words; a
    word carries one blank on either side. Long texts are counted slice by slice."""
    symbol = _symbols()
    parts = []
    carry = np.zeros(1, np.int64)
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    for lo in range(0, len(text), SLICE):
        cps = np.frombuffer(text[lo: lo + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        s = np.concatenate([carry, symbol[cps]])
        if lo + SLICE >= len(text):
            s = np.append(s, 0)
        s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]  # runs of blanks are one
        # grams that end in this slice; the symbols carried over begin some of them
        own = len(carry)
        one = s[own:]
        two = (s[:-1] * BASE + s[1:])[own - 1:]
        three = (s[:-2] * BASE + s[1:-1]) * BASE + s[2:]
        one = one[one != 0]
        parts.append(np.unique(np.concatenate([one + BASE**3, two + 2 * BASE**3, three]), return_counts=True))
        carry = s[-2:]
    if len(parts) == 1:
        return parts[0]
    return _merged(parts)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


def top_ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes in order; ties by code."""
    if len(codes) > size:
        cut = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= cut], counts[counts >= cut]
    return codes[np.lexsort((codes, -counts))][:size]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """(lang, code, place): the ``size`` most frequent n-grams of each language over all given rows;
    null text or language teaches nothing. Counts are summed in the task first, and a language
    has at most one row per distinct n-gram and task in the shuffle."""
    def run(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = held.setdefault(lang, [])
                parts.append(ngram_counts(text))
                if len(parts) >= 256:
                    held[lang] = [_merged(parts)]
        for lang, parts in held.items():
            codes, counts = _merged(parts)
            for lo in range(0, len(codes), 50_000):
                c = codes[lo: lo + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(c.astype(np.int64)), pa.array(counts[lo: lo + 50_000].astype(np.int64))],
                    names=["lang", "code", "n"])
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    counts = rows.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.col("n").desc(), "code")
    ranked = counts.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= size)   # Spark limits each task's groups first
    return ranked.select("lang", "code", (F.col("place") - 1).alias("place"))


class Profiles:
    """Profiles of all languages as one table of places."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.codes = np.array(sorted({r[1] for r in rows}), np.int64)
        self.places = np.full((len(self.langs), len(self.codes) + 1), -1, np.int32)  # the last column: no such n-gram
        for lang, code, place in rows:
            self.places[self.langs.index(lang), np.searchsorted(self.codes, code)] = place

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the language of least out-of-place distance, ties to the first by name;
        score 1 for the language's own order, 0 where no n-gram is in its profile."""
        if text is None or not self.langs:
            return UNDETERMINED, 0.0
        codes, counts = ngram_counts(text)
        if not len(codes):
            return UNDETERMINED, 0.0
        own = top_ranked(codes, counts, self.size)
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        places = self.places[:, at]
        gap = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))))
        distance = gap.sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], float(1.0 - distance[best] / (self.size * len(own)))


def collect_profiles(profiles: DataFrame, size: int = PROFILE) -> Profiles:
    """The profiles on the driver: ``size`` rows per language, whatever the corpus."""
    return Profiles([(r["lang"], r["code"], r["place"]) for r in profiles.collect()], size)


def predict_languages(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_out: str = "lang_pred",
                      score_out: str = "score") -> DataFrame:
    """``docs`` without its text column plus the predicted language and score. Null text, or text
    without a letter, is ``und`` with score 0."""
    others = [c for c in docs.columns if c not in (text_col, lang_out, score_out)]
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        model = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            valid = batch.column(0).is_valid().to_pylist()
            for lo, hi in row_groups(offsets):
                block, o = data[offsets[lo]: offsets[hi]].tobytes(), (offsets[lo: hi + 1] - offsets[lo]).tolist()
                got = [model.predict(block[x:y].decode("utf-8") if ok else None) for x, y, ok in zip(o, o[1:], valid[lo:hi])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                     *(c.slice(lo, hi - lo) for c in batch.columns[1:])], names=["__lang", "__score", *(f"__c{i}" for i in range(len(others)))])
    kinds = dict(docs.dtypes)
    quoted = ["`" + c.replace("`", "``") + "`" for c in others]
    src = docs.select(F.col("`" + text_col.replace("`", "``") + "`").cast("string"), *(F.col(q).alias(f"__c{i}") for i, q in enumerate(quoted)))
    out = src.mapInArrow(run, ", ".join(["__lang string", "__score double", *(f"__c{i} {kinds[c]}" for i, c in enumerate(others))]))
    return out.select(*(F.col(f"__c{i}").alias(c) for i, c in enumerate(others)), F.col("__lang").alias(lang_out), F.col("__score").alias(score_out))


def training_rows(docs: DataFrame, id_col: str = "doc_id", folds: int = 5):
    """Column: true for held-out rows (crc32 of the id as text divisible by ``folds``); a null id is
    neither held out nor learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): profiles learned from the rows not held out, then every
    row predicted from its text alone."""
    held = training_rows(docs, id_col)
    profiles = collect_profiles(learn_profiles(docs.filter(~held), text_col, lang_col, size), size)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return predict_languages(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")


def score_floor(scored: DataFrame, lang_col: str = "lang", pred_col: str = "lang_pred", score_col: str = "score",
                share: float = FLOOR_SHARE, worst: float = FLOOR_WORST) -> float:
    """The score below which a text is taken to be in none of the learned languages: ``share`` of the score
    that all but ``worst`` of the labelled texts reach. It comes from a histogram of all labelled rows,
    so the driver gets ``FLOOR_BINS`` + 1 counts; 0 without a labelled row."""
    rows = scored.filter(F.col(lang_col).isNotNull() & (F.col(pred_col) != UNDETERMINED))
    bins = sorted((r["bin"], r["count"]) for r in rows.groupBy(F.floor(F.col(score_col) * FLOOR_BINS).alias("bin")).count().collect())
    left = worst * sum(n for _, n in bins)
    for at, n in bins:
        if left < n:
            return share * at / FLOOR_BINS
        left -= n
    return 0.0


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """The rows of ``docs`` that are in a language it has profiles of, learned from its rows not held out: texts
    that are null, have no letter or score below ``score_floor`` are left out. Every row is scored once;
    the scored rows are written, as the floor follows from all of them."""
    held = training_rows(docs, id_col)
    profiles = collect_profiles(learn_profiles(docs.filter(~held), text_col, lang_col, size), size)
    body = docs.withColumn("__body", F.col("`" + text_col.replace("`", "``") + "`").cast("string"))
    scored = materialize(predict_languages(body, profiles, "__body", "__pred", "__score"), "scored")
    floor = score_floor(scored, lang_col, "__pred", "__score")
    return scored.filter((F.col("__pred") != UNDETERMINED) & (F.col("__score") >= floor)).drop("__pred", "__score")
