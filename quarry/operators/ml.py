"""Feature scaling, k-means archetypes (MLlib) and OLS residual ranking.

A k-means fit is a distributed MLlib job. A regression is solved from one mergeable aggregate of
means and co-moments. What reaches the driver is sized by centres and features, not by the data.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.clustering import KMeans  # noqa: F401 - the tests compare with it
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import half_even_round
from quarry.session import ship_package


def _scale_stats(df: DataFrame, features: Sequence[str]) -> list[Column]:
    return [*[F.avg(c).alias(f"_m_{c}") for c in features], *[F.stddev_pop(c).alias(f"_s_{c}") for c in features]]


def standardize(df: DataFrame, features: Sequence[str], suffix: str = "_z", *, once: bool = False) -> DataFrame:
    """(x - mean) / population std per feature (unit *population* variance, as
    scikit-learn's StandardScaler; MLlib's scaler divides by the sample std).
    The statistics are one row, joined as a broadcast of proven size 1; with ``once`` they are
    found at once, for a result that is scanned more than once."""
    stats = df.agg(*_scale_stats(df, features))
    if once:
        stats = df.sparkSession.createDataFrame(stats.collect(), stats.schema)
    out = df.crossJoin(F.broadcast(stats))
    for c in features:
        s = F.col(f"_s_{c}")
        out = out.withColumn(c + suffix, F.when(s > 0, (F.col(c) - F.col(f"_m_{c}")) / s)
                             .otherwise(F.lit(0.0)))
    return out.drop(*[f"_m_{c}" for c in features], *[f"_s_{c}" for c in features])


# ------------------------------------------------------------------ k-means

def _vectors(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


# Fixed value: scikit-learn's default tolerance on the summed squared centre
# shift, relative to the mean feature variance (1 after standardisation).
SKLEARN_TOL = 1e-4


def _mllib_tol(k: int, tol: float = SKLEARN_TOL) -> float:
    """MLlib stops when every centre moves less than ``epsilon`` (a distance);
    a total squared shift of ``tol`` over k centres is about sqrt(tol / k) each."""
    return math.sqrt(tol / k)


def _scan(rows: DataFrame, work) -> list:
    """What ``work(index, matrices)`` gives for each partition, in their order; the matrices (features x points)
    hold the partition's rows in order. ``rows`` has columns of doubles, or one of vectors."""
    if any(isinstance(f.dataType, VectorUDT) for f in rows.schema):
        rows = rows.select(*[vector_to_array(f.name) for f in rows.schema if isinstance(f.dataType, VectorUDT)])

    def run(batches):
        index = TaskContext.get().partitionId()
        for out in work(index, map(_matrix, batches)):
            yield pa.RecordBatch.from_arrays([pa.array([index], pa.int32()), pa.array([pickle.dumps(out)], pa.binary())], names=["index", "out"])
    got = rows.mapInArrow(run, "index int, out binary").collect()
    return [(r[0], pickle.loads(r[1])) for r in sorted(got, key=lambda r: r[0])]


def _matrix(batch) -> np.ndarray:
    if pa.types.is_list(batch.schema.field(0).type):
        return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
    return np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], dtype=float)


def _gathered(matrices, points: int):
    """The matrices joined to such of ``points`` points, the last one of fewer."""
    held, n = [], 0
    for m in matrices:
        while m.shape[1]:
            take = m[:, : points - n]
            held.append(take)
            n, m = n + take.shape[1], m[:, take.shape[1]:]
            if n == points:
                yield np.concatenate(held, axis=1)
                held, n = [], 0
    if n:
        yield np.concatenate(held, axis=1)


SAMPLE = 1 << 17       # points by which space is cut into regions, at most


def _survey(rows: DataFrame) -> tuple[list[int], np.ndarray, float, np.ndarray]:
    """(rows of each partition, sums of the features, sum of their squares, some points from all over the rows)."""
    most = max(64, SAMPLE // max(1, rows.rdd.getNumPartitions()))

    def work(index, matrices):
        n, total, square, every, held = 0, 0.0, 0.0, 1, []
        for m in matrices:
            held.append(m[:, -n % every:: every].copy())
            n, total, square = n + m.shape[1], total + m.sum(axis=1), square + float((m * m).sum())
            if sum(h.shape[1] for h in held) > 2 * most:
                held, every = [np.concatenate(held, axis=1)[:, ::2]], every * 2
        if n:
            yield n, total, square, every, np.concatenate(held, axis=1)
    got = _scan(rows, work)
    if not got:
        raise ValueError("k-means has no points")
    every = max(g[3] for _, g in got)
    counts = [0] * (1 + max(i for i, _ in got))
    for i, g in got:
        counts[i] = g[0]
    return counts, sum(g[1] for _, g in got), sum(g[2] for _, g in got), np.concatenate([g[4][:, :: every // g[3]] for _, g in got], axis=1)


# MLlib's random numbers: a 64-bit xorshift, whose state after any number of steps is a linear map of its bits.

def _murmur(data: bytes, h: int) -> int:
    def turn(x, r):
        return (x << r | x >> 32 - r) & 0xFFFFFFFF
    for i in range(0, len(data), 4):
        k = turn(int.from_bytes(data[i: i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = (turn(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _state(seed: int) -> int:
    """The state in which Spark's XORShiftRandom starts from a seed."""
    data = (seed & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(state):
    """The next state; of an int or an array of them."""
    word = 0xFFFFFFFFFFFFFFFF
    if not isinstance(state, int):
        state = state ^ state << np.uint64(21)
        state ^= state >> np.uint64(35)
        state ^= state << np.uint64(4)
        return state
    state ^= state << 21 & word
    state ^= state >> 35
    return state ^ state << 4 & word


def _int(x: int) -> int:
    return (x + (1 << 31)) % (1 << 32) - (1 << 31)


def _applied(bits: np.ndarray, states: np.ndarray) -> np.ndarray:
    """The linear map that takes bit i to ``bits[i]``, of each state."""
    out = np.zeros_like(states)
    for i in range(64):
        out ^= bits[i] * (states >> np.uint64(i) & np.uint64(1))
    return out


LANES, LANE = 1024, 256      # runs of random numbers that are drawn side by side, and their length


def _draws(states: np.ndarray):
    """MLlib's uniform numbers for runs of LANES * LANE rows, one line per state."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for _ in range(2):
        bits = _step(bits)
    jumps, steps = [], 1
    while steps < LANES * LANE:
        if steps >= LANE:
            jumps.append(bits)
        bits, steps = _applied(bits, bits), steps * 2
    while True:
        lanes = states[:, None]
        for jump in jumps:
            lanes = np.concatenate([lanes, _applied(jump, lanes)], axis=1)
        out = np.empty((LANE, *lanes.shape))
        for i in range(LANE):
            lanes = _step(lanes)
            high = lanes & np.uint64((1 << 26) - 1)
            lanes = _step(lanes)
            out[i] = (high << np.uint64(27)) + (lanes & np.uint64((1 << 27) - 1))
        out *= 2.0 ** -53
        yield out.transpose(1, 2, 0).reshape(len(states), -1)
        states = _applied(bits, states)


def _sampled(counts: Sequence[int], fraction: float, seed: int, jvm) -> list[tuple[int, int]]:
    """(partition, row) of the rows that RDD.sample takes without replacement."""
    seeds, out = jvm.java.util.Random(seed), []
    for part, n in enumerate(counts):
        state = _state(seeds.nextLong())

        def uniform():
            nonlocal state
            state = _step(state)
            high = state & (1 << 26) - 1
            state = _step(state)
            return ((high << 27) + (state & (1 << 27) - 1)) * 2.0 ** -53
        if fraction > 0.4:
            out += [(part, i) for i in range(n) if uniform() <= fraction]
            continue
        row, rest = -1, math.log1p(-fraction)
        while row < n:
            row += 1 + int(math.log(max(uniform(), 5e-11)) / rest)
            if row < n:
                out.append((part, row))
    return out


def _first_row(counts: Sequence[int], seed: int, jvm) -> tuple[int, int]:
    """(partition, row) of the row that RDD.takeSample gives for one row without replacement."""
    total, random = sum(counts), jvm.java.util.Random(seed)
    if total == 1:
        got = [(i, 0) for i, n in enumerate(counts) if n]
    else:
        gamma = -math.log(1e-4) / total
        fraction = min(1.0, max(1e-10, 1 / total + gamma + math.sqrt(gamma * gamma + 2 * gamma / total)))
        got = []
        while not got:
            got = _sampled(counts, fraction, random.nextInt(), jvm)
    for i in range(len(got) - 1, 0, -1):
        j = random.nextInt(i + 1)
        got[i], got[j] = got[j], got[i]
    return got[0]


def _chosen(rows: DataFrame, seeds: Sequence[int], step: int, firsts: np.ndarray, factors: np.ndarray) -> list[list[tuple[float, np.ndarray]]]:
    """For each seed the (random number, point) of the rows whose number in MLlib's ``step`` is below its factor times
    the squared distance to its first centre, in the order of the rows."""
    def work(index, matrices):
        states = np.array([_state(_int(s ^ step << 16 ^ index)) for s in seeds], dtype=np.uint64)
        for m, u in zip(_gathered(matrices, LANES * LANE), _draws(states)):
            found = []
            for i, (c, f) in enumerate(zip(firsts, factors)):
                hit = np.flatnonzero(u[i, : m.shape[1]] < f * ((m - c[:, None]) ** 2).sum(axis=0))
                found.append((u[i, hit], m[:, hit].T))
            yield found
    got = [g for _, g in _scan(rows, work)]
    return [[(float(u), x) for g in got for u, x in zip(*g[i])] for i in range(len(seeds))]


def _start_centres(rows: DataFrame, specs: Sequence[tuple[int, int]], parallel: int = 0, survey=None, blocks=None) -> list[np.ndarray]:
    """The starting centres of each (k, seed), as by MLlib's k-means|| in two steps: as many as there are distinct points,
    at most k. All searches share their scans of the rows and draw MLlib's own random numbers for each row, so the
    centres are those of MLlib's fit over the same partitions; no cost is kept for a row. ``parallel`` has no meaning any more."""
    jvm = rows.sparkSession._jvm
    survey = survey or _survey(rows)
    if blocks is None:
        blocks = _point_blocks(rows, rows.columns, survey)
    counts, total, square, _ = survey
    n, seeds = sum(counts), sorted({s for _, s in specs})
    drawn = [_int(_step(_state(s))) for s in seeds]
    wanted: dict[int, dict[int, list[int]]] = {}
    for i, s in enumerate(drawn):
        part, row = _first_row(counts, s, jvm)
        wanted.setdefault(part, {}).setdefault(row, []).append(i)

    def fetch(index, matrices):
        left, at = dict(wanted.get(index, {})), 0
        while left:
            m = next(matrices)
            for row in [r for r in left if r < at + m.shape[1]]:
                yield left.pop(row), m[:, row - at].copy()
            at += m.shape[1]
    firsts = np.empty((len(seeds), len(total)))
    for _, (which, x) in _scan(rows, fetch):
        firsts[which] = x

    most = max(k for k, _ in specs)
    costs = [max(0.0, square - 2 * float(c @ total) + n * float(c @ c)) for c in firsts]
    found = _chosen(rows, drawn, 0, firsts, np.array([2.0 * most / c if c > 0 else 0.0 for c in costs]))
    centres = []
    for k, s in specs:
        i = seeds.index(s)
        centres.append(np.array([firsts[i], *[x for u, x in found[i] if u < 2.0 * ((x - firsts[i]) ** 2).sum() * k / costs[i]]]))
    costs = [max(0.0, c) for _, c in _pass(blocks, centres)]
    factors = [max(2.0 * k / c if c > 0 else 0.0 for (k, s), c in zip(specs, costs) if s == seed) for seed in seeds]
    found = _chosen(rows, drawn, 1, firsts, np.array(factors))
    for f, ((k, s), cost) in enumerate(zip(specs, costs)):
        near = [(u, x, ((centres[f] - x) ** 2).sum(axis=1).min()) for u, x in found[seeds.index(s)]]
        more = np.array([*centres[f], *[x for u, x, c in near if cost > 0 and u < 2.0 * c * k / cost]])
        centres[f] = more[np.sort(np.unique(more, axis=0, return_index=True)[1])]
    weighed = [sums[:, -1] for sums, _ in _pass(blocks, centres)]
    return [c if len(c) <= k else _local_centres(c, w, k, jvm) for (k, _), c, w in zip(specs, centres, weighed)]


def _local_centres(points: np.ndarray, weights: np.ndarray, k: int, jvm) -> np.ndarray:
    """k centres of weighted points: MLlib's local k-means++ with its seed and its 30 iterations at most."""
    random = jvm.java.util.Random(0)

    def reached(shares: np.ndarray) -> np.ndarray:
        sums = np.cumsum(shares)
        return points[min(int(np.searchsorted(sums, random.nextDouble() * sums[-1])), len(points) - 1)]
    centres = np.empty((k, points.shape[1]))
    centres[0] = reached(weights)
    cost = ((points - centres[0]) ** 2).sum(axis=1)
    for i in range(1, k):
        centres[i] = reached(weights * cost)
        cost = np.minimum(cost, ((points - centres[i]) ** 2).sum(axis=1))
    last = None
    for _ in range(30):
        near = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        if last is not None and (near == last).all():
            break
        last = near
        for j in range(k):
            mine = near == j
            total = weights[mine].sum()
            centres[j] = (weights[mine, None] * points[mine]).sum(axis=0) / total if total > 0 else points[random.nextInt(len(points))]
    return centres


REGION = 1 << 20       # points of one region, about
PLAIN = 4096           # points up to which a block is one matrix
LEAF, FAN = 32, 4      # points of a leaf, about; parts of a node
TOP = 8192             # leaves of a block, at most
FITS = 16              # fits that search a block together
TILE = 1 << 16         # distances held at a time


def _regions(sample: np.ndarray, parts: int, first: int = 0):
    """Space cut into ``parts`` regions of about as many points: (feature, bound, regions up to it, regions above),
    or (first part, parts) where the points are one, which are dealt in turn."""
    j = int(np.argmax(np.ptp(sample, axis=1))) if sample.shape[1] else 0
    if parts == 1 or sample.shape[1] < 2 or np.ptp(sample[j]) == 0:
        return first, parts
    x, want = np.sort(sample[j]), sample.shape[1] * (parts // 2) / parts
    at = x[max(0, int(want) - 1)]
    below, upto = np.searchsorted(x, at), np.searchsorted(x, at, "right")
    bound = at if upto < len(x) and (below == 0 or upto - want <= want - below) else x[below - 1]
    low = sample[j] <= bound
    share = min(max(1, round(parts * np.count_nonzero(low) / len(x))), parts - 1)
    return j, bound, _regions(sample[:, low], share, first), _regions(sample[:, ~low], parts - share, first + share)


def _dealt(x: np.ndarray, region):
    """(part, points) of a matrix."""
    if len(region) == 2:
        first, parts = region
        for i in range(min(parts, x.shape[1])):
            yield first + i, x[:, i::parts]
        return
    low = x[region[0]] <= region[1]
    yield from _dealt(x[:, low], region[2])
    yield from _dealt(x[:, ~low], region[3])


def _point_blocks(df: DataFrame, cols: Sequence[str], survey=None):
    """The rows of ``cols`` as an RDD of blocks (see _blocks), each of points of one region."""
    rows = df.select(*cols) if any(isinstance(df.schema[c].dataType, VectorUDT) for c in cols) else df.select(*[F.col(c).cast("double") for c in cols])
    counts, _, _, sample = survey or _survey(rows)
    if len(cols) == 1 and isinstance(rows.schema[0].dataType, VectorUDT):
        rows = rows.select(vector_to_array(cols[0]))
    width, n, cores = len(sample), sum(counts), df.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-n // (REGION * cores)) * cores if n > REGION else 0, min(cores, n // (4 * PLAIN)), 1)
    regions = _regions(sample, parts)

    def deal(batches):
        for m in _gathered(map(_matrix, batches), REGION // 2):
            for part, x in _dealt(m, regions):
                if x.shape[1]:
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())], names=["part", "points"])

    def build(part):
        for m in _gathered((np.frombuffer(r[0]).reshape(width, -1) for r in part), 2 * REGION):
            yield from _blocks(m)
    return rows.mapInArrow(deal, "part int, points binary").repartitionById(parts, F.col("part")).select("points").rdd.mapPartitions(build)


def _blocks(x: np.ndarray):
    """Points as one block (their sum of squares, a matrix with a last row of ones), or, if they are many, as blocks of (sum of squares,
    leaves x features x points, least and greatest values and sums and counts of the leaves): each leaf holds points that are
    near each other, and so does each block. Leaves are filled with points of zeros that count for nothing."""
    width, n = x.shape
    if n <= PLAIN:
        yield float((x * x).sum()), np.vstack([x, np.ones(n)])
        return
    bits = round(math.log2(n / LEAF))
    size, spread, give = -(-n // 2 ** bits), np.ptp(x, axis=1), np.zeros(width, dtype=int)
    for _ in range(bits):
        give[np.argmax(spread / 2.0 ** give)] += 1
    y = np.full((width, size << bits), np.inf)
    y[:, :n] = x
    order, nodes, low, place = [int(j) for j in np.argsort(-give) if give[j]], 1, bits, {}
    for i, j in enumerate(order):      # cut by one feature after the other; equal values by the next
        key = (y[j] + 1e-6 * y[order[(i + 1) % len(order)]]).reshape(nodes, -1)
        at = (np.argsort(key, axis=1) + np.arange(nodes)[:, None] * key.shape[1]).ravel()
        for d in range(width):
            y[d] = y[d].take(at)
        nodes, low = nodes << int(give[j]), low - int(give[j])
        place[j] = (np.arange(1 << bits) >> low) & ((1 << int(give[j])) - 1)
    left, z = give.copy(), np.zeros(1 << bits, dtype=int)
    for _ in range(bits):              # the leaves in z-order of their places
        j = int(np.argmax(np.where(left > 0, spread / 2.0 ** (give - left), -1.0)))
        left[j] -= 1
        z = z << 1 | place[j] >> int(left[j]) & 1
    y = y.reshape(width, -1, size).take(np.argsort(z), axis=1)
    real = y[0] < np.inf
    least = y.min(axis=2)
    y[:, ~real] = -np.inf
    most = y.max(axis=2)
    y[:, ~real] = 0
    count = real.sum(axis=1)
    least[:, count == 0] = most[:, count == 0] = 0
    sums = np.vstack([y.sum(axis=2), count])
    for lo in range(0, 1 << bits, TOP):
        part = slice(lo, lo + TOP)
        yield float((y[:, part] ** 2).sum()), y[:, part].transpose(1, 0, 2).copy(), least[:, part].copy(), most[:, part].copy(), sums[:, part].copy()


def _levels(least: np.ndarray, most: np.ndarray, sums: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(middles, half widths, sums and counts) of the nodes of each level, from the root to the leaves."""
    out = [(least, most, sums)]
    while out[-1][0].shape[1] > 1:
        a, b, s = out[-1]
        fan = min(FAN, a.shape[1])
        low, high, total = a[:, ::fan].copy(), b[:, ::fan].copy(), s[:, ::fan].copy()
        for i in range(1, fan):
            np.minimum(low, a[:, i::fan], out=low)
            np.maximum(high, b[:, i::fan], out=high)
            total += s[:, i::fan]
        out.append((low, high, total))
    return [((a + b) / 2, (b - a) / 2, s) for a, b, s in reversed(out)]


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a[0] * b[0]
    for x, y in zip(a[1:], b[1:]):
        out += x * y
    return out


def _add(into: np.ndarray, key: np.ndarray, rows: np.ndarray) -> None:
    for line, row in zip(into, rows):
        line += np.bincount(key, row, into.shape[1])


def _sums(centres: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums and counts of the points nearest to each centre, cost of each fit) of one block, for fits of equally
    many centres (fits x centres x features). A point goes to the first of equally near centres."""
    fits, k, width = centres.shape
    flat = centres.reshape(fits * k, width)
    by = np.column_stack([-flat, (flat * flat).sum(axis=1) / 2])   # half the squared distance, less the point's own part
    total, cost = np.zeros((fits * k, width + 1)), np.zeros(fits)
    step = max(64, TILE // len(by))
    for lo in range(0, block.shape[1], step):
        x = block[:, lo: lo + step]
        far = (by @ x).reshape(fits, k, -1)
        near = far.min(axis=1)
        hit = far == near[:, None, :]
        if np.count_nonzero(hit) != near.size:
            hit = np.arange(k)[:, None] == far.argmin(axis=1)[:, None, :]
        total += hit.reshape(fits * k, -1).astype(np.float64) @ x.T
        cost += 2 * near.sum(axis=1) + (x[:-1] * x[:-1]).sum()
    return total.reshape(fits, k, width + 1), cost


def _left(centres: np.ndarray, there: np.ndarray, middle: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Which of the centres (fits x centres) there are may be nearest to a point in a box."""
    far = np.where(there, (centres * centres).sum(axis=2) / 2 - centres @ middle, np.inf)
    near = far.argmin(axis=1)[:, None]
    best = np.take_along_axis(centres, near[:, :, None], axis=1)
    return there & (far - np.take_along_axis(far, near, axis=1) <= np.abs(centres - best) @ wide)


def _leaf_sums(fits: Sequence[np.ndarray], block: tuple) -> list[np.ndarray]:
    """For each fit's centres the sums and counts of the points nearest to them, of a block with leaves. A centre is struck
    off for a node when another one is nearer in the whole box of the node; a node with one centre left counts by its sums.
    Of the others, the next level's nodes are tried, and in the end the points of the leaves. With two centres
    left, all goes to the first (p) and what is nearer to the second (q) is moved. A point goes to the first of equally near centres."""
    _, points, *stats = block
    levels, (_, width, size) = _levels(*stats), points.shape
    n, most = len(fits), max(len(c) for c in fits)
    centres, there = np.zeros((n, most, width)), np.zeros((n, most), dtype=bool)
    for f, c in enumerate(fits):
        centres[f, : len(c)], there[f, : len(c)] = c, True
    middle, wide, sums = levels[0]
    there = _left(centres, there, middle[:, 0], wide[:, 0])
    result = [np.zeros((len(c), width + 1)) for c in fits]
    for f in np.flatnonzero(there.sum(axis=1) == 1):
        result[f][there[f].argmax()] = sums[:, 0]
    open_fits = np.flatnonzero(there.sum(axis=1) > 1)
    if not len(open_fits):
        return result
    n, most = len(open_fits), int(there.sum(axis=1).max())     # the centres that are left, put first
    order = np.argsort(~there[open_fits], axis=1, kind="stable")[:, :most]
    centres = np.take_along_axis(centres[open_fits], order[:, :, None], axis=1)
    there = np.take_along_axis(there[open_fits], order, axis=1)
    own = (centres * centres).sum(axis=2) / 2
    between = np.ascontiguousarray((centres[:, None] - centres[:, :, None]).reshape(-1, width).T)    # by (fit, p, q): q - p
    bound = (own[:, None, :] - own[:, :, None]).ravel()
    table, half = np.ascontiguousarray(centres.transpose(2, 1, 0)), np.ascontiguousarray(np.where(there, own, np.inf).T)
    flat, out, moved = table.reshape(width, -1), np.zeros((width + 1, n * most)), np.zeros((width + 1, n * most * most))
    counts = levels[-1][2][-1]
    fit, at, on = np.arange(n), np.zeros(n, dtype=int), there.T.copy()
    pair = pair_at = np.empty(0, dtype=int)
    for level, (middle, wide, sums) in enumerate(levels):
        if level:
            fan = middle.shape[1] // levels[level - 1][0].shape[1]
            fit, on, pair = fit.repeat(fan), on.repeat(fan, axis=1), pair.repeat(fan)
            at, pair_at = ((x[:, None] * fan + np.arange(fan)).ravel() for x in (at, pair_at))
        if len(pair):
            w = between.take(pair, axis=1)
            gap = _dot(w, middle.take(pair_at, axis=1)) - bound.take(pair)
            reach = _dot(np.abs(w, out=w), wide.take(pair_at, axis=1))
            whole = np.flatnonzero(gap > reach)
            _add(moved, pair[whole], sums.take(pair_at[whole], axis=1))
            keep = np.flatnonzero(np.abs(gap, out=gap) <= reach)
            pair, pair_at = pair[keep], pair_at[keep]
        if len(fit):
            c, m, h = table.take(fit, axis=2), middle.take(at, axis=1), wide.take(at, axis=1)
            far = half.take(fit, axis=1)
            for d in range(width):
                far -= c[d] * m[d]
            np.copyto(far, np.inf, where=~on)
            near = far.argmin(axis=0)
            far -= far.min(axis=0)
            best = flat.take(near * n + fit, axis=1)
            for d in range(width):
                x = c[d]
                x -= best[d]
                far -= np.abs(x, out=x) * h[d]
            on &= far <= 0
            left = np.add.reduce(on, axis=0, dtype=np.int32)
            few = np.flatnonzero(left <= 2)
            p, q, f = on[:, few].argmax(axis=0), most - 1 - on[::-1, few].argmax(axis=0), fit[few]
            _add(out, f * most + p, sums.take(at[few], axis=1))
            two = left[few] == 2
            pair, pair_at = np.concatenate([pair, ((f * most + p) * most + q)[two]]), np.concatenate([pair_at, at[few][two]])
            rest = np.flatnonzero(left > 2)
            fit, at, on = fit[rest], at[rest], on[:, rest]
    step = max(1, TILE // (size * width))
    for lo in range(0, len(pair), step):
        p, a = pair[lo: lo + step], pair_at[lo: lo + step]
        x, w, b = points.take(a, axis=0), between.take(p, axis=1)[:, :, None], bound.take(p)
        gap = x[:, 0] * w[0]
        for d in range(1, width):
            gap += x[:, d] * w[d]
        goes = (gap > b[:, None]).astype(float)
        _add(moved, p, [*[np.einsum("ap,ap->a", x[:, d], goes) for d in range(width)],
                        goes @ np.ones(size) - np.where(b < 0, size - counts.take(a), 0)])
    step = max(1, TILE // (size * most))
    for lo in range(0, len(fit), step):
        f, a = fit[lo: lo + step], at[lo: lo + step]
        x = points.take(a, axis=0)
        near = (half.T.take(f, axis=0)[:, :, None] - centres.take(f, axis=0) @ x).argmin(axis=1)
        real = np.arange(size) < counts.take(a)[:, None]
        key = (f[:, None] * most + near)[real]
        _add(out, key, [*[x[:, d][real] for d in range(width)], np.ones(len(key))])
    moved = moved.reshape(width + 1, n, most, most)
    out = out.reshape(width + 1, n, most) + moved.sum(axis=2) - moved.sum(axis=3)
    for i, f in enumerate(open_fits):
        result[f][order[i][there[i]]] = out[:, i, there[i]].T
    return result


def _block_sums(fits: Sequence[np.ndarray], block: tuple) -> list[np.ndarray]:
    """For each fit's centres the sums and counts of the points nearest to them, of a block of either kind."""
    if len(block) > 2:
        return [sums for lo in range(0, len(fits), FITS) for sums in _leaf_sums(fits[lo: lo + FITS], block)]
    out: list = [None] * len(fits)
    for k in {len(c) for c in fits}:
        some = [f for f, c in enumerate(fits) if len(c) == k]
        for f, total in zip(some, _sums(np.stack([fits[f] for f in some]), block[1])[0]):
            out[f] = total
    return out


def _pass(blocks, fits: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """(sums and counts of the points nearest to each centre, cost) of each fit, by one job of a task per core, as the
    start of a task costs more than the search of a block. A task sends its sums."""
    def run(part):
        held, square = None, 0.0
        for block in part:
            got = _block_sums(fits, block)
            held, square = got if held is None else [a + b for a, b in zip(held, got)], square + block[0]
        return [] if held is None else [(held, square)]
    got = blocks.coalesce(blocks.context.defaultParallelism).mapPartitions(run).collect()
    square, out = sum(s for _, s in got), []
    for f, c in enumerate(fits):
        sums = sum(held[f] for held, _ in got)
        out.append((sums, square - float((2 * c * sums[:, :-1]).sum() - (sums[:, -1] * (c * c).sum(axis=1)).sum())))
    return out


def _lloyd(blocks, starts: Sequence[np.ndarray], tols: Sequence[float], max_iter: int) -> list[tuple[np.ndarray, float]]:
    """(centres, cost) of Lloyd's iterations from each of ``starts``. One job per iteration serves every fit that
    still runs, and the driver makes the new centres. As in
    MLlib, a fit ends when each of its centres moves by its tolerance at most, a centre without points
    stays, and the cost is that of the last assignment."""
    centres, cost = [c.copy() for c in starts], [math.nan] * len(starts)
    running, passes = list(range(len(starts))), 0
    while running and passes < max_iter:
        tried, running, passes = running, [], passes + 1
        for f, (total, c) in zip(tried, _pass(blocks, [centres[f] for f in tried])):
            count = total[:, -1:]
            moved = np.where(count > 0, total[:, :-1] / np.maximum(count, 1), centres[f])
            shift = ((moved - centres[f]) ** 2).sum(axis=1)
            centres[f], cost[f] = moved, c
            if (shift > tols[f] ** 2).any():
                running.append(f)
    return list(zip(centres, cost))


def _fit_many(data: DataFrame, cols: Sequence[str], specs: Sequence[tuple[int, int]], max_iter: int, parallel: int):
    """(k, seed, centres, cost) of one k-means per (k, seed): the starts of all fits and then their iterations
    over one set of blocks."""
    ship_package(data.sparkSession)
    rows = data.select(*[F.col(c).cast("double") for c in cols])
    survey = _survey(rows)
    blocks = _point_blocks(rows, rows.columns, survey).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        starts = _start_centres(rows, specs, parallel, survey, blocks)
        fits = _lloyd(blocks, starts, [_mllib_tol(k) for k, _ in specs], max_iter)
    finally:
        blocks.unpersist()
    return [(k, seed, c, cost) for (k, seed), (c, cost) in zip(specs, fits)]


def _known(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows whose ``cols`` are neither null nor NaN."""
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.filter(known)


def kmeans_best(df: DataFrame, features: Sequence[str], k: int, *, seed: int = 42,
                n_init: int = 10, max_iter: int = 300, scale: bool = True, parallel: int = 10):
    """Fit k-means ``n_init`` times (seeds seed..seed+n_init-1) and keep the fit
    with the lowest within-cluster sum of squares. Returns (centres, assigned
    frame with ``cluster``, cost). Costs are scalars compared on the driver."""
    feats = list(features)
    data = standardize(df, feats, once=True) if scale else df
    cols = [c + "_z" for c in feats] if scale else feats
    data = _known(data, cols)
    fits = _fit_many(data, cols, [(k, seed + i) for i in range(n_init)], max_iter, parallel)
    _, _, centres, cost = min(fits, key=lambda f: (f[3], f[1]))
    return centres, assign(data, cols, centres.tolist()), cost


def elbow_curve(df: DataFrame, features: Sequence[str], ks: Sequence[int] = range(2, 9), *,
                seed: int = 42, n_init: int = 10, max_iter: int = 300, parallel: int = 10) -> DataFrame:
    """(k, inertia) for every k: best-of-``n_init`` within-cluster sum of squares."""
    spark = df.sparkSession
    feats = list(features)
    cols = [c + "_z" for c in feats]
    fits = _fit_many(_known(standardize(df, feats, once=True), cols), cols, [(k, seed + i) for k in ks for i in range(n_init)], max_iter, parallel)
    best: dict[int, float] = {}
    for k, _, _, cost in fits:
        best[k] = min(cost, best.get(k, math.inf))
    return spark.createDataFrame([(int(k), best[k]) for k in ks], "k long, inertia double")


def _scaled_columns(features: Sequence[str], mean: Sequence[float], std: Sequence[float]) -> list[Column]:
    return [(F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) if math.isfinite(s) else F.lit(0.0) * F.col(c)
            for c, m, s in zip(features, mean, std)]


def assign(df: DataFrame, features: Sequence[str], centres, mean=None, std=None, out: str = "cluster", distance: str | None = None) -> DataFrame:
    """``df`` with the number of the nearest of ``centres`` (the first of equal ones), as plain column
    arithmetic; ``distance`` names a column for the squared distance. A NULL feature gives NULL."""
    mean = [0.0] * len(features) if mean is None else mean
    std = [1.0] * len(features) if std is None else std
    z, far = _scaled_columns(features, mean, std), []
    for centre in centres:
        d = F.lit(0.0)
        for x, c in zip(z, centre):
            d = d + (x - F.lit(float(c))) * (x - F.lit(float(c)))
        far.append(d)
    known = df.withColumn("_far", F.array(*far))
    known = known.withColumn(out, F.when(F.element_at("_far", 1).isNotNull(), F.array_position("_far", F.array_min("_far")).cast("int") - 1))
    if distance:
        known = known.withColumn(distance, F.array_min("_far"))
    return known.drop("_far")


def cluster_profile(assigned: DataFrame, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """Mean of each column per cluster, rounded half-to-even (pandas ``.round``)."""
    return (assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        *[half_even_round(F.avg(c), digits).alias(c) for c in columns]).orderBy("cluster"))


# ------------------------------------------------------------------ least squares

def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (n, means, moments): count, means and the upper triangle of the matrix of summed products
    of deviations, row by row, over the rows without a NULL. One aggregate that combines within tasks."""
    names = list(columns)
    rows = df.dropna(subset=names)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return rows.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in names]).alias("means"),
                    F.array(*[F.covar_pop(a, b) * F.count(F.lit(1)) for a, b in pairs]).alias("moments"))


def merge_co_moments(parts: DataFrame, width: int) -> DataFrame:
    """The moments of several loads (rows as by ``co_moments``) as those of all their rows together."""
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    some = parts.filter("n > 0")
    n = F.sum("n")
    mean = [F.sum(F.col("n") * F.col("means")[i]) / n for i in range(width)]
    whole = some.crossJoin(F.broadcast(some.agg(*[m.alias(f"_m{i}") for i, m in enumerate(mean)])))   # one row
    off = [F.col("means")[i] - F.col(f"_m{i}") for i in range(width)]
    return whole.agg(F.sum("n").alias("n"), F.array(*[F.max(f"_m{i}") for i in range(width)]).alias("means"),
                     F.array(*[F.sum(F.col("moments")[k] + F.col("n") * off[i] * off[j]) for k, (i, j) in enumerate(pairs)]).alias("moments"))


@dataclass(frozen=True)
class LinearFit:
    """Intercept and coefficients of a least-squares fit, and the share of variance that it explains."""
    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    r2: float

    def predicted(self) -> Column:
        out = F.lit(self.intercept)
        for c, b in zip(self.features, self.coefficients):
            out = out + F.lit(b) * F.col(c)
        return out


def solve_moments(moments: DataFrame, features: Sequence[str]) -> LinearFit:
    """The fit of the last column on the others from their moments (one row, read by the driver). Columns
    that depend on each other share their weight (least norm)."""
    row, width = moments.first(), len(features) + 1
    full = np.zeros((width, width))
    full[np.triu_indices(width)] = [math.nan if x is None else x for x in row["moments"]]
    full = full + np.triu(full, 1).T
    if not row["n"] or not np.isfinite(full).all():
        return LinearFit(tuple(features), math.nan, tuple([math.nan] * len(features)), math.nan)
    size = np.sqrt(np.where(np.diag(full) > 0, np.diag(full), 1.0))   # correlations are better conditioned than sums
    scaled = full / np.outer(size, size)
    beta = np.linalg.lstsq(scaled[:-1, :-1], scaled[:-1, -1], rcond=None)[0] * size[-1] / size[:-1]
    means = np.array(row["means"])
    explained = float(beta @ full[:-1, -1])
    return LinearFit(tuple(features), float(means[-1] - beta @ means[:-1]), tuple(float(b) for b in beta), explained / full[-1, -1] if full[-1, -1] > 0 else math.nan)


def ols_fit(df: DataFrame, label: str, features: Sequence[str], *, log_label: bool = True):
    """Ordinary least squares with intercept, from one pass for the moments.

    Rows with a NULL in the used columns, or a non-positive label when
    ``log_label``, are dropped first. Returns (fit, frame with
    ``predicted`` and ``residual``, r2)."""
    used = list(features) + [label]
    data = df.dropna(subset=used)
    if log_label:
        data = data.filter(F.col(label) > 0).withColumn("_y", F.log(F.col(label)))
    else:
        data = data.withColumn("_y", F.col(label).cast("double"))
    fit = solve_moments(co_moments(data.select(*[F.col(c).cast("double") for c in features], "_y"), [*features, "_y"]), features)
    scored = data.withColumn("predicted", fit.predicted()).withColumn("residual", F.col("_y") - F.col("predicted"))
    return fit, scored, fit.r2


def residual_extremes(scored: DataFrame, k: int, columns: Sequence[str],
                      tie_break: Sequence[str] = ()) -> DataFrame:
    """The k most negative ('under') and k most positive ('over') residuals.
    Each side is a TakeOrderedAndProject (k rows per partition at most)."""
    tb = [F.col(c).asc() for c in tie_break]
    keep = list(columns) + ["predicted", "residual"]
    under = (scored.orderBy(F.col("residual").asc(), *tb).limit(k).select(*keep)
             .withColumn("side", F.lit("under")))
    over = (scored.orderBy(F.col("residual").desc(), *tb).limit(k).select(*keep)
            .withColumn("side", F.lit("over")))
    return under.unionByName(over)
