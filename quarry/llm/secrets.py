"""Secret scanning: pattern matches plus sliding-window entropy over candidate strings.

Candidates are cut at separators, so what stands beside a key in a path, an address or an
assignment neither hides it nor goes with it. Random strings of letters of one case alone are not
told from words and are not looked for.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._common import row_groups, text_buffer

# fixed patterns
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")     # the maximal runs of 16 or more
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

# entropy: a run of the characters of keys is cut at its separators into pieces; a candidate is an irregular
# piece, or several that separators of base64 join
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PIECE = re.compile(r"[A-Za-z0-9]+")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")    # a word, an acronym or a number
CANDIDATE_CHARS, SHORT_CHARS = 20, 3
#: Per character class: the candidates it holds, its alphabet's size, and the share of the bits that a
#: window of ``WINDOW`` characters could have at most which a secret's must reach.
WINDOW = 20
CLASSES = {"entropy_hex": (re.compile(r"(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+"), 16, 0.68), "entropy_base64": (re.compile(r"[A-Za-z0-9+/_-]+"), 64, 0.72)}
PARTS_SHARE, PARTS_LEAST = 0.29, 4   # an irregular piece has as many parts a character, or as many in all if of a single case
#: Pieces that are no secrets: examples and counted-up digits or letters.
ALLOW = (re.compile(r"(?i).*(?:example|sample|dummy|placeholder|xxxx|1234567890|abcdef).*"),)
#: Runs that are no secrets: universally unique ids.
ALLOW_RUN = (re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),)


def window_entropy(s: str, width: int) -> float:
    """Largest Shannon entropy (bits per character) of the windows of ``width`` characters of ``s``;
    counts are kept up as the window moves, so each step costs two terms."""
    width = min(width, len(s))
    if not width:
        return 0.0
    term = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    for ch in s[:width]:
        counts[ch] = counts.get(ch, 0) + 1
    total = sum(term[c] for c in counts.values())
    least = total
    for old, new in zip(s, s[width:]):
        if old != new:
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
            c = counts.get(new, 0)
            total += term[c + 1] - term[c]
            counts[new] = c + 1
            least = min(least, total)
    return math.log2(width) - least / width


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches, code points, end exclusive."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def irregular(piece: str) -> bool:
    """Whether letters and digits change within a piece as they don't in words, numbers and names put together.
    Letters of one case alone never do."""
    parts = len(PART.findall(piece))
    return parts >= PARTS_SHARE * len(piece) or (parts >= PARTS_LEAST and piece in (piece.lower(), piece.upper()))


def candidates(run: str, allow: tuple[re.Pattern, ...] = ALLOW) -> list[tuple[int, int]]:
    """(start, end) of the candidate strings of a run: irregular pieces that no allow-list pattern covers,
    joined where one separator, or a short piece between two, stands between them."""
    out: list[list[int]] = []
    for m in PIECE.finditer(run):
        if len(m[0]) <= SHORT_CHARS:   # too short to tell; it may join its neighbours
            continue
        if not irregular(m[0]) or any(a.fullmatch(m[0]) for a in allow):
            continue
        if out and m.start() - out[-1][1] <= SHORT_CHARS + 2 and not any(len(x) > SHORT_CHARS for x in PIECE.findall(run[out[-1][1]: m.start()])):
            out[-1][1] = m.end()
        else:
            out.append([m.start(), m.end()])
    return [(a, b) for a, b in out if b - a >= CANDIDATE_CHARS]


def entropy_spans(text: str, allow: tuple[re.Pattern, ...] = ALLOW, classes: dict | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the candidates with a window of high entropy for their character class."""
    out = []
    for run in RUN.finditer(text):
        if any(a.fullmatch(run[0]) for a in ALLOW_RUN):
            continue
        for a, b in candidates(run[0], allow):
            found = run[0][a:b]
            kind = next(k for k, (pattern, _, _) in (classes or CLASSES).items() if pattern.fullmatch(found))
            _, symbols, share = (classes or CLASSES)[kind]
            if window_entropy(found, WINDOW) >= share * math.log2(min(WINDOW, symbols)):
                out.append((run.start() + a, run.start() + b, kind))
    return out


def scan_text(text: str, allow: tuple[re.Pattern, ...] = ALLOW) -> tuple[list, list]:
    """(base spans, all spans), both by start, then kind. Candidates are looked for in what the base
    spans leave of the text, so a secret joined to one is found by itself."""
    base = base_spans(text)
    extra, at = [], 0
    for start, end, _ in [*base, (len(text), len(text), "")]:
        extra += [(s + at, e + at, kind) for s, e, kind in entropy_spans(text[at:start], allow)]
        at = max(at, end)
    return base, sorted(base + extra, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _texts(batch: pa.RecordBatch):
    data, offsets = text_buffer(batch.column(1))
    for lo, hi in row_groups(offsets):
        block, o = data[offsets[lo]: offsets[hi]].tobytes(), (offsets[lo: hi + 1] - offsets[lo]).tolist()
        yield lo, [block[x:y].decode("utf-8") for x, y in zip(o, o[1:])]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of each whole text.

    Null or empty text has no spans (empty strings and the digest of one). Repeated rows and other
    columns are left as they are; an empty table gives none.
    """
    def run(batches):
        for batch in batches:
            for lo, texts in _texts(batch):
                found = [scan_text(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)),
                     *(pa.array([sum(x[2] == k for x in base) for base, _ in found], pa.int64()) for k in KINDS[:3]),
                     pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                     pa.array([joined(every) for _, every in found], pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"))


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """``text`` with every span, or run of spans that overlap, replaced by ``mark``. Of an assignment
    the value goes and its name stays."""
    out, at = [], 0
    for start, end, kind in spans:
        if kind == "assign":
            start = ASSIGN.match(text, start).start(2)
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets in ``text_col`` replaced and ``chars_col`` (if it has one) counted anew where
    the text changed; no row goes, and a text without secrets stays as it is, null included."""
    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if t is None else redact(t, scan_text(t)[1]) for t in texts], pa.string()), *batch.columns[1:]],
                names=["__text", *batch.schema.names[1:]])
    names = docs.columns
    others = [c for c in names if c != text_col]
    kinds = dict(docs.dtypes)
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in names}
    src = docs.select(F.col(quoted[text_col]).cast("string").alias("__text"), *(F.col(quoted[c]).alias(f"__c{i}") for i, c in enumerate(others)),
                      F.length(F.col(quoted[text_col])).alias("__was"))
    schema = ", ".join(["__text string", *(f"__c{i} {kinds[c]}" for i, c in enumerate(others)), "__was int"])
    out = src.mapInArrow(run, schema)
    back = {c: F.col(f"__c{i}") for i, c in enumerate(others)} | {text_col: F.col("__text")}
    if chars_col in back:
        now = F.length("__text")
        back[chars_col] = F.when(now.eqNullSafe(F.col("__was")), back[chars_col]).otherwise(now.cast(kinds[chars_col]))
    return out.select(*(back[c].alias(c) for c in names))
