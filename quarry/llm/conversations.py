"""Repair of conversation structure by a parallel Viterbi search with rank convergence.

The least costly edits that make a conversation's roles read ``(s?(ua)+)?`` are a shortest path over
four states (nothing yet, after system, after user, after assistant). Conversations are cut into
chunks of turns. Every chunk runs backwards from a speculative cost vector; fix-up passes hand each
chunk the vector that its successor came to and rerun those chunks whose vector differs by more
than a constant, until none does. The stitched backward costs then say, turn by turn, which edits
lie on a cheapest path, and the tracing takes the least in ASCII order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._common import materialize, ship_package

# fixed values: costs of the edits, the states and what follows in them
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)                      # the role that may be inserted or given in a state
KEEP = ({SYSTEM: SYSTEM, USER: USER}, {USER: USER}, {ASSISTANT: ASSISTANT}, {USER: USER})   # state -> initial -> state
ROLE = {USER: "user", ASSISTANT: "assistant"}
FINAL = (0, 2 * INSERT, INSERT, 0)                        # cost of ending in each state

CHUNK = 512          # turns of a chunk
FIX_UPS = 6          # passes before chunks whose vectors never converge are solved by products
FAN = 256            # chunks multiplied in one task
BIG = 1 << 40

# code of a row: initial (1 system, 2 user, 3 assistant, 0 another) and faults
FAULTS = {"truncated": 4, "blank": 8, "duplicate": 16}
FORCED = FAULTS["blank"] | FAULTS["duplicate"]


def _costs(after: tuple[int, ...], code: int) -> tuple[list[int], list[int]]:
    """Backward costs before a row, without and with insertions in the gap before it."""
    cut = TRUNCATED if code & FAULTS["truncated"] else 0
    bare = []
    for s in range(4):
        to = KEEP[s].get(code & 3)
        bare.append(min(DELETE + after[s], REROLE + cut + after[NEXT[s]], BIG << 1 if to is None else cut + after[to]))
    return bare, [min(bare[s], INSERT + bare[NEXT[s]], 2 * INSERT + bare[NEXT[NEXT[s]]]) for s in range(4)]


@lru_cache(1 << 16)
def step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int]:
    """(vector before the row less its minimum, that minimum)."""
    if code & FORCED:
        return after, DELETE
    costs = _costs(after, code)[1]
    least = min(costs)
    return tuple(c - least if c - least < BIG >> 1 else BIG for c in costs), least


@lru_cache(1 << 16)
def choose(after: tuple[int, ...], code: int, state: int) -> tuple[str, int]:
    """(edits, state after them): the insertions before a row and its own edit that are cheapest, least in
    ASCII order. In a state every edit leads to one state only, so the least letter decides."""
    if code & FORCED:
        return "D", state
    cut = TRUNCATED if code & FAULTS["truncated"] else 0
    costs, edits = _costs(after, code)[1], ""
    while True:
        if DELETE + after[state] == costs[state]:
            return edits + "D", state
        if INSERT + costs[NEXT[state]] == costs[state]:
            edits, state = edits + "I", NEXT[state]
            continue
        to = KEEP[state].get(code & 3)
        if to is not None and cut + after[to] == costs[state]:
            return edits + "K", to
        return edits + "R", NEXT[state]


def backward(codes: bytes, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """(vector before a chunk's first row, constant) for the vector after its last one."""
    total = 0
    for code in reversed(codes):
        after, least = step(after, code)
        total += least
    return after, total


def trace(codes: bytes, after: tuple[int, ...], state: int, last: bool) -> tuple[list[str], int]:
    """The edits of each row, and those behind the last one if the conversation ends here, along the
    cheapest path from ``state``; and the state they lead to."""
    vectors = [after]
    for code in reversed(codes):
        vectors.append(step(vectors[-1], code)[0])
    out = []
    for k, code in enumerate(codes):
        edits, state = choose(vectors[len(codes) - 1 - k], code, state)
        out.append(edits)
    ending = ""
    while last and state in (SYSTEM, USER):
        ending, state = ending + "I", NEXT[state]
    return [*out, ending], state


def applied(edits: list[str], extras: list[int], roles: list[str], texts: list[str], state: int, codes: bytes) -> tuple[str, list[dict]]:
    """(audit, repaired turns) of a chunk. ``extras``: copies of each row right behind it, all deleted."""
    audit, turns = [], []
    for k, letters in enumerate(edits):
        for letter in letters:
            if letter == "I":
                state = NEXT[state]
                turns.append({"role": ROLE[state], "text": ""})
            elif letter == "K":
                state = KEEP[state][codes[k] & 3]
                turns.append({"role": roles[k], "text": texts[k]})
            elif letter == "R":
                state = NEXT[state]
                turns.append({"role": ROLE[state], "text": texts[k]})
        audit.append(letters)
        if k < len(extras) and extras[k]:
            audit.append("D" * extras[k])
    return "".join(audit), turns


# --- chunks ---------------------------------------------------------------------------------

_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
STATS = ("blank", "duplicate", "truncated", "illegal", "distinct_turns")
TURNS = "array<struct<role:string,text:string>>"
CHUNKS = ("ckey string, part int, no long, " + ", ".join(f"{c} long" for c in STATS) + ", min_turn long, max_turn long, first_turn long, last_turn long, "
          "first_code int, last_code int, cost long, audit string, turns " + TURNS + ", codes binary, extras array<long>, roles array<string>, texts array<string>")
_LIST, _TURNS = pa.list_(pa.string()), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_TYPES = {"ckey": pa.string(), "part": pa.int32(), "first_code": pa.int32(), "last_code": pa.int32(), "audit": pa.string(), "codes": pa.binary(),
          "extras": pa.list_(pa.int64()), "roles": _LIST, "texts": _LIST, "turns": _TURNS}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    names = [c.strip().split(" ")[0] for c in schema.replace("struct<role:string,text:string>", "turn").split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], _TYPES.get(c, pa.int64())) for c in names], names=names)


def _described(codes: list[int], copies: list[int], turns: list[int | None]) -> dict:
    """What a run of rows adds to its conversation's statistics."""
    out = dict.fromkeys(STATS, 0)
    for k, (code, n) in enumerate(zip(codes, copies)):
        if code & FAULTS["blank"]:
            out["blank"] += n
        elif code & FAULTS["duplicate"]:
            out["duplicate"] += n
        else:
            out["duplicate"] += n - 1
            out["truncated"] += bool(code & FAULTS["truncated"])
        out["illegal"] += n - 1 + (k > 0 and (codes[k - 1] & 3, code & 3) not in _LEGAL)
    known = [t for t in turns if t is not None]
    out["distinct_turns"] = len(set(known))
    return out | {"min_turn": min(known, default=None), "max_turn": max(known, default=None), "first_turn": turns[0], "last_turn": turns[-1],
                  "first_code": codes[0] & 3, "last_code": codes[-1] & 3}


def _cut_chunks(chunk: int) -> Callable:
    def run(batches):
        part, no = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, turns, roles, texts, codes, copies = (c.to_pylist() for c in batch.columns)
            n, lo, out = len(keys), 0, []
            while lo < n:
                hi = lo + 1
                while hi < n and hi - lo < chunk and keys[hi] == keys[lo]:
                    hi += 1
                own = slice(lo, hi)
                row = {"ckey": keys[lo]} | _described(codes[own], copies[own], turns[own])
                raw, extras = bytes(codes[own]), [c - 1 for c in copies[own]]
                if lo and hi < n and keys[lo - 1] != keys[lo] != keys[hi]:   # the whole conversation
                    edits, _ = trace(raw, FINAL, START, True)
                    vector, cost = backward(raw, FINAL)
                    row["audit"], row["turns"] = applied(edits, extras, roles[own], texts[own], START, raw)
                    row["cost"] = cost + vector[START] + DELETE * sum(extras)
                else:   # it may go on before or behind
                    row |= {"part": part, "no": no, "codes": raw, "extras": extras, "roles": roles[own], "texts": texts[own]}
                    no += 1
                out.append(row)
                lo = hi
            if out:
                yield _batch(out, CHUNKS)
    return run


def _ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows with their code, in order: conversations by range over the tasks, a long one over several.
    Equal rows are one with a count; whether role and text were seen before follows from the first
    turn that has them, joined by the row's own key."""
    digest = F.unhex(F.sha2("text", 256))
    coded = rows.select("ckey", F.col("turn").isNotNull().alias("timed"), F.coalesce("turn", F.lit(0)).alias("at"), "role", digest.alias("digest"), "text", "copies")
    key = ["ckey", "timed", "at", "role", "digest"]
    first = (coded.groupBy("ckey", "role", "digest").agg(F.min(F.struct("timed", "at")).alias("m"))
             .select("ckey", F.col("m.timed").alias("timed"), F.col("m.at").alias("at"), "role", "digest", F.lit(True).alias("new")))
    once = coded.groupBy(*key).agg(F.sum("copies").alias("copies"), F.max("text").alias("text")).join(first, key, "left")
    blank = ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    cut = ~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    initial = F.substring("role", 1, 1)
    code = (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
            + F.when(blank, FAULTS["blank"]).when(F.col("new").isNull(), FAULTS["duplicate"]).when(cut, FAULTS["truncated"]).otherwise(0))
    spread = once.withColumn("code", code).withColumn("text", F.when(F.col("code") < FAULTS["blank"], F.col("text")))   # of rows that go, no text is needed
    return (spread.repartitionByRange(*key).sortWithinPartitions(*key)
            .select("ckey", F.when(F.col("timed"), F.col("at")).alias("turn"), "role", "text", F.col("code").cast("int"), F.col("copies").cast("long")))


# --- vectors and states along a conversation -------------------------------------------------

def _run_chunks(rerun_only: bool) -> Callable:
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                if not rerun_only or r["given"] != r["wanted"]:
                    vector, r["cost"] = backward(r["codes"], tuple(r["wanted"]))
                    r["given"], r["vector"] = r["wanted"], list(vector)
            yield pa.RecordBatch.from_pylist([{c: r[c] for c in PASS_COLUMNS} for r in rows], PASS_ARROW)
    return run


PASS = "ckey string, at long, last boolean, codes binary, given array<long>, vector array<long>, cost long"
PASS_COLUMNS = ("ckey", "at", "last", "codes", "given", "vector", "cost")
PASS_ARROW = pa.schema([("ckey", pa.string()), ("at", pa.int64()), ("last", pa.bool_()), ("codes", pa.binary()), ("given", pa.list_(pa.int64())),
                        ("vector", pa.list_(pa.int64())), ("cost", pa.int64())])


def _final() -> F.Column:
    return F.array(*map(F.lit, FINAL)).cast("array<long>")


def stitched_vectors(chunks: DataFrame, fix_ups: int = FIX_UPS, fan: int = FAN) -> DataFrame:
    """``chunks`` (ckey, at, last, codes) with ``given``, the cost vector behind each chunk less its
    minimum, ``vector``, that before it, and ``cost``, the constant between them.

    The first pass is speculative: every chunk is given the vector of a conversation's end. Each
    fix-up pass gives it what its successor has come to and reruns it if that differs by more than a
    constant; passes end when none differs. Conversations whose vectors pass through their chunks
    unconverged (all turns of one role, say) would need a pass per chunk: after ``fix_ups`` passes
    those are solved by min-plus products of the chunks, ``fan`` at a time.
    """
    held = materialize(chunks.withColumn("wanted", _final()).withColumn("given", F.lit(None).cast("array<long>"))
                       .mapInArrow(_run_chunks(False), PASS), "pass")
    for passes in range(fix_ups + 1):
        successor = held.select("ckey", (F.col("at") - 1).alias("at"), F.col("vector").alias("next"))
        wanted = held.join(successor, ["ckey", "at"], "left").withColumn("wanted", F.when(F.col("last"), _final()).otherwise(F.col("next")))
        stale = wanted.filter("given <> wanted")
        if not stale.limit(1).count():
            return held
        if passes < fix_ups:
            held = materialize(wanted.mapInArrow(_run_chunks(True), PASS), "pass")
    open_keys = materialize(stale.select("ckey").distinct(), "unconverged")
    rest = held.join(open_keys, "ckey", "left_semi")

    def products(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                columns = []
                for t in range(4):
                    vector, cost = backward(r["codes"], tuple(0 if s == t else BIG for s in range(4)))
                    columns.append([min(BIG, v + cost) for v in vector])
                out.append({"ckey": r["ckey"], "at": r["at"], "value": [columns[t][s] for s in range(4) for t in range(4)]})
            yield pa.RecordBatch.from_pylist(out, _ELEMENTS_ARROW)
    given = carried(rest.mapInArrow(products, ELEMENTS), _BackwardCosts(), fan)
    solved = (rest.drop("given").join(given, ["ckey", "at"]).withColumn("wanted", F.col("given")).mapInArrow(_run_chunks(False), PASS))
    return materialize(held.join(open_keys, "ckey", "left_anti").unionByName(solved), "pass")


class _BackwardCosts:
    """Chunks as 4 x 4 min-plus matrices, from the end of a conversation to its start."""
    first = list(FINAL)
    backwards = True

    @staticmethod
    def onward(value: list[int], given: list[int]) -> list[int]:
        out = [min(value[4 * s + t] + given[t] for t in range(4)) for s in range(4)]
        return [x - min(out) for x in out]

    @staticmethod
    def joined(near: list[int], far: list[int]) -> list[int]:
        """The product of ``near``, which comes first on the way, and ``far``."""
        out = [min(far[4 * s + k] + near[4 * k + t] for k in range(4)) for s in range(4) for t in range(4)]
        least = min(out)
        return [x - least if x - least < BIG >> 1 else BIG for x in out]


class _StateMaps:
    """Chunks as maps of the state before them to the state behind them, from the start on."""
    first = [START]
    backwards = False

    @staticmethod
    def onward(value: list[int], given: list[int]) -> list[int]:
        return [value[given[0]]]

    @staticmethod
    def joined(near: list[int], far: list[int]) -> list[int]:
        return [far[s] for s in near]


ELEMENTS = "ckey string, at long, value array<long>"
_ELEMENTS_ARROW = pa.schema([("ckey", pa.string()), ("at", pa.int64()), ("value", pa.list_(pa.int64()))])
_GIVEN_ARROW = pa.schema([("ckey", pa.string()), ("at", pa.int64()), ("given", pa.list_(pa.int64()))])


def carried(elements: DataFrame, kind, fan: int = FAN) -> DataFrame:
    """(ckey, at, given): what reaches each element of its conversation. Elements are joined ``fan`` at a
    time until a conversation is one element, and what reaches a group is then carried through it,
    level by level; no task sees more than ``fan`` elements of a conversation at once."""
    block = F.floor(F.col("at") / fan).alias("block")

    def join(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["at"], reverse=kind.backwards)
        value = rows[0]["value"]
        for r in rows[1:]:
            value = kind.joined(value, r["value"])
        return pa.Table.from_pylist([{"ckey": rows[0]["ckey"], "at": rows[0]["block"], "value": value}], _ELEMENTS_ARROW)

    def carry(group: pa.Table) -> pa.Table:
        out, given = [], None
        for r in sorted(group.to_pylist(), key=lambda r: r["at"], reverse=kind.backwards):
            given = r["given"] if given is None else given
            out.append({"ckey": r["ckey"], "at": r["at"], "given": given})
            given = kind.onward(r["value"], given)
        return pa.Table.from_pylist(out, _GIVEN_ARROW)

    levels = [materialize(elements, "elements")]
    while levels[-1].groupBy("ckey").count().filter("count > 1").limit(1).count():
        levels.append(materialize(levels[-1].select("ckey", "at", "value", block).groupBy("ckey", "block").applyInArrow(join, ELEMENTS), "elements"))
    given = levels.pop().select("ckey", "at", F.array(*map(F.lit, kind.first)).cast("array<long>").alias("given"))
    while levels:
        above = given.select("ckey", F.col("at").alias("block"), "given")
        given = materialize(levels.pop().select("ckey", "at", "value", block).join(above, ["ckey", "block"])
                            .groupBy("ckey", "block").applyInArrow(carry, "ckey string, at long, given array<long>"), "given")
    return given


def _numbered(open_chunks: DataFrame) -> DataFrame:
    """Open chunks with ``at``, their place in the order of all of them, and whether they begin and end
    their conversation. The offsets have a row per task."""
    sizes = open_chunks.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("offset"))
    at = materialize(open_chunks.join(F.broadcast(offsets), "part").select("part", "no", "ckey", (F.col("offset") + F.col("no")).alias("at"), "codes",
                     "first_turn", "last_turn", "first_code", "last_code"), "open")
    before = at.select("ckey", (F.col("at") + 1).alias("at"), F.col("last_turn").alias("turn_before"), F.col("last_code").alias("code_before"))
    behind = at.select("ckey", (F.col("at") - 1).alias("at"), F.lit(False).alias("last"))
    return (at.join(before, ["ckey", "at"], "left").join(behind, ["ckey", "at"], "left")
            .withColumn("last", F.coalesce("last", F.lit(True))).withColumn("starts", F.col("code_before").isNull()))


PIECES = ["ckey", "at", *STATS, "min_turn", "max_turn", "cost", "audit", "turns"]


def repair_pieces(rows: DataFrame, chunk: int = CHUNK, fix_ups: int = FIX_UPS, fan: int = FAN) -> DataFrame:
    """Pieces of repaired conversations, at most ``chunk`` different turns each, as a written table.

    ``rows`` has ckey (a string), turn (long), role, text (not null) and copies. A piece has its
    place ``at`` (null where it is the whole conversation), its share of the statistics and costs,
    its audit and its repaired turns.
    """
    ship_package(rows.sparkSession)
    cut = materialize(_ordered_rows(rows).mapInArrow(_cut_chunks(chunk), CHUNKS), "chunks")
    whole = cut.filter("no is null").withColumn("at", F.lit(None).cast("long"))
    numbered = materialize(_numbered(cut.filter("no is not null")), "numbered")
    vectors = stitched_vectors(numbered.select("ckey", "at", "last", "codes"), fix_ups, fan)

    def maps(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"ckey": r["ckey"], "at": r["at"], "value": [trace(r["codes"], tuple(r["given"]), s, r["last"])[1] for s in range(4)]}
                                              for r in batch.to_pylist()], _ELEMENTS_ARROW)
    states = carried(vectors.mapInArrow(maps, ELEMENTS), _StateMaps(), fan).select("ckey", "at", F.col("given")[0].alias("state"))

    legal = F.concat_ws("", F.col("code_before").cast("string"), F.col("first_code").cast("string")).isin([f"{x}{y}" for x, y in _LEGAL])
    seam = F.col("code_before").isNotNull()
    place = (numbered.drop("codes", "last", "first_turn", "last_turn", "first_code", "last_code").join(vectors.drop("codes"), ["ckey", "at"])
             .join(states, ["ckey", "at"]).drop("ckey").withColumn("start_cost", F.when(F.col("starts"), F.col("vector")[START]).otherwise(0) + F.col("cost")).drop("cost"))
    opened = (cut.filter("no is not null").join(place, ["part", "no"])
              .withColumn("illegal", F.col("illegal") + F.when(seam & ~legal, 1).otherwise(0))
              .withColumn("distinct_turns", F.col("distinct_turns") - F.when(seam & (F.col("turn_before") == F.col("first_turn")), 1).otherwise(0))
              .withColumn("cost", F.col("start_cost") + F.aggregate("extras", F.lit(0).cast("long"), lambda n, x: n + x) * DELETE)
              .select(*PIECES[:-2], "codes", "given", "state", "last", "extras", "roles", "texts"))
    kept = PIECES[:-2]

    def traced(batches):
        for batch in batches:
            audits, turns = [], []
            for r in batch.select(["codes", "given", "state", "last", "extras", "roles", "texts"]).to_pylist():
                edits, _ = trace(r["codes"], tuple(r["given"]), r["state"], r["last"])
                audit, repaired = applied(edits, r["extras"], r["roles"], r["texts"], r["state"], r["codes"])
                audits.append(audit)
                turns.append(repaired)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(audits, pa.string()), pa.array(turns, _TURNS)], names=PIECES)
    pieces = opened.mapInArrow(traced, "ckey string, at long, " + ", ".join(f"{c} long" for c in kept[2:]) + ", audit string, turns " + TURNS)
    return whole.select(*PIECES).unionByName(materialize(pieces, "pieces"))


def summaries(pieces: DataFrame) -> DataFrame:
    """Per conversation (ckey): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The digest of a conversation in several pieces is taken by one task that streams its pieces in
    order, one row per piece; a digest of bytes in order allows nothing else.
    """
    stats = pieces.groupBy("ckey").agg(*(F.sum(c).alias(c) for c in (*STATS, "cost")), F.min("min_turn").alias("lo"), F.max("max_turn").alias("hi"))
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = pieces.filter("at is null").select("ckey", "audit", F.sha2(body, 256).alias("repaired_sha256"))

    def run(batches):
        key, audit, digest, empty = None, [], None, True
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["ckey"] != key:
                    if key is not None:
                        out.append({"ckey": key, "audit": "".join(audit), "sha": digest.hexdigest()})
                    key, audit, digest, empty = r["ckey"], [], hashlib.sha256(), True
                audit.append(r["audit"])
                if r["body"]:
                    digest.update(r["body"].encode() if empty else b"\n" + r["body"].encode())
                    empty = False
            yield pa.RecordBatch.from_pylist(out, _DIGESTS_ARROW)
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"ckey": key, "audit": "".join(audit), "sha": digest.hexdigest()}], _DIGESTS_ARROW)
    several = (pieces.filter("at is not null").select("ckey", "at", "audit", body.alias("body")).repartition("ckey").sortWithinPartitions("ckey", "at")
               .mapInArrow(run, "ckey string, audit string, sha string").withColumnRenamed("sha", "repaired_sha256"))
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("distinct_turns"), F.lit(0))
    return (stats.join(whole.unionByName(several), "ckey")
            .select("ckey", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


_DIGESTS_ARROW = pa.schema([("ckey", pa.string()), ("audit", pa.string()), ("sha", pa.string())])


# --- the operator ---------------------------------------------------------------------------

def _name(column: str) -> F.Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _filled(column: str) -> F.Column:
    return F.coalesce(_name(column).cast("string"), F.lit(" "))


def conversation_key(conv: F.Column) -> F.Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def keyed(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role: F.Column | None = None, text: F.Column | None = None,
          copies: F.Column | None = None, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(ckey, turn, role, text, copies) of a table of turns; null roles and texts are one space, a null
    conversation is one of its own."""
    return turns.select(conversation_key(_name(conv_col)).alias("ckey"), _name(turn_col).cast("long").alias("turn"),
                        (_filled(role_col) if role is None else role).alias("role"), (_filled(text_col) if text is None else text).alias("text"),
                        (F.lit(1) if copies is None else copies).cast("long").alias("copies"))


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``turns`` as by ``keyed`` and damaged by a checksum of conversation and number: of twenty one each is
    dropped, emptied, loses its full stops, is repeated behind itself or becomes the user's."""
    kind = F.crc32(F.concat(_filled(conv_col), F.lit(":"), _filled(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(_filled(text_col), "[.!?]", "")).otherwise(_filled(text_col))
    return keyed(turns.filter(kind != 0), conv_col, turn_col, F.when(kind == 4, F.lit("user")).otherwise(_filled(role_col)), text,
                 F.when(kind == 3, 2).otherwise(1))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(ckey, piece, position, role, text): the turns of every conversation of ``rows`` (as by ``keyed``)
    after the cheapest repair."""
    return repair_pieces(rows).select("ckey", F.coalesce("at", F.lit(0)).alias("piece"), F.posexplode("turns").alias("position", "turn")).select(
        "ckey", "piece", "position", "turn.role", "turn.text")


def audit_conversations(turns: DataFrame, rows: DataFrame | None = None, conv_col: str = "conv_id", chunk: int = CHUNK, fix_ups: int = FIX_UPS, fan: int = FAN) -> DataFrame:
    """One row per conversation of ``turns``: (conv_col, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256).

    ``rows`` (as by ``keyed``) are audited, those of ``turns`` by default; a conversation without any
    has zeros, an empty audit and the digest of nothing. Rows are taken by turn, null first; rows
    of one turn by role, then by the digest of their text; equal rows stand together. Null roles
    and texts are one space, a null conversation is one of its own, an empty table gives none;
    other columns play no part.
    """
    found = summaries(repair_pieces(keyed(turns, conv_col) if rows is None else rows, chunk, fix_ups, fan))
    every = turns.select(_name(conv_col).alias("__conv"), conversation_key(_name(conv_col)).alias("ckey")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, "ckey", "left").select(
        F.col("__conv").alias(conv_col), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
