"""MinHash near-duplicate detection with sequential Bayesian verification.

Documents are sets of distinct word shingles. Equal sets are one class from the start. Each
class representative gets ``bands * rows`` MinHash values: the bands propose candidates, one byte
of every value is kept as a sketch. Candidate pairs are compared sketch batch by sketch batch; a
pair is dropped as soon as the posterior probability that its similarity reaches the threshold is
below ``miss``. Survivors are confirmed on their full sets.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._common import arrow_rows, materialize, mix64, row_groups, text_buffer, word_hashes
from quarry.llm._graph import connected_components

BANDS, ROWS = 30, 5      # a pair of similarity 0.8 is missed with probability 7e-6
BATCH = 30               # sketch bytes compared at a time
MISS = 1e-6              # chosen miss probability of the Bayesian pruning
CHUNK = 512              # members of a bucket compared block against block
FILTER_BITS = 25         # a bit map of 4 MB says which documents' sets may be asked for


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each document. A document of fewer words is one
    shingle; one without words has none."""
    h, doc = word_hashes(data, offsets)
    n = len(offsets) - 1
    first = np.searchsorted(doc, np.arange(n + 1))
    count = np.diff(first)

    def joined(at: np.ndarray, k: int) -> np.ndarray:
        out = np.full(len(at), k, np.uint64)
        for j in range(k):
            out = mix64(out * np.uint64(0x9FB21C651E98DF25) + h[at + j])
        return out

    width = max(len(h) - words + 1, 0)
    runs = joined(np.arange(width), words)
    out = []
    for d in range(n):
        if count[d] >= words:
            out.append(np.unique(runs[first[d]: first[d + 1] - words + 1]))
        elif count[d]:
            out.append(joined(first[d: d + 1], int(count[d])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return (rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32),
            rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1))


def signatures(sets: list[np.ndarray], n_hashes: int) -> np.ndarray:
    """MinHash values (documents x hashes, uint32); rows of empty sets are 0."""
    out = np.zeros((len(sets), n_hashes), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    x = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    flip, times = _hash_family(n_hashes)
    buf = np.empty_like(x)
    mins = np.empty((n_hashes, len(full)), np.uint32)
    for k in range(n_hashes):
        np.bitwise_xor(x, flip[k], out=buf)
        np.multiply(buf, times[k], out=buf)
        np.minimum.reduceat(buf, at, out=mins[k])
    out[full] = mins.T
    return out


FEATURES = "doc_id long, n long, fp1 long, fp2 long, bands array<long>, sketch binary"


def _features(words: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in row_groups(offsets):
                o = offsets[lo: hi + 1]
                sets = shingle_sets(data[o[0]: o[-1]], o - o[0], words)
                sig = signatures(sets, bands * rows)
                keys = np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
                keys = np.broadcast_to(keys, (hi - lo, bands)).copy()
                parts = sig.reshape(hi - lo, bands, rows).astype(np.uint64)
                for r in range(rows):
                    keys = mix64(keys * np.uint64(0x9FB21C651E98DF25) + parts[:, :, r] + np.uint64(1))
                sketch = (sig & np.uint32(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(mix64(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets], pa.int64()),
                    pa.array([int(mix64(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).astype(np.int64)) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * bands, pa.int32()), pa.array(keys.view(np.int64).ravel())),
                    pa.array([row.tobytes() for row in sketch], pa.binary()),
                ], names=["doc_id", "n", "fp1", "fp2", "bands", "sketch"])
    return run


def _sets(words: int, asked):
    """Shingle sets of the documents that the bit map lets through."""
    def run(batches):
        bits = asked.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            slot = _slot(ids)
            keep = pa.array((bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1)
            batch = batch.filter(keep)
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in row_groups(offsets):
                o = offsets[lo: hi + 1]
                sets = shingle_sets(data[o[0]: o[-1]], o - o[0], words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["doc_id", "shingles"])
    return run


def _slot(ids: np.ndarray) -> np.ndarray:
    return mix64(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)


def _asked_map(ids: DataFrame) -> np.ndarray:
    """Bit map of some ids. Tasks hash them, a grouped bit_or adds them up, and the driver gets at
    most 2^(FILTER_BITS - 6) words however many ids there are; more ids only let more through."""
    def run(batches):
        for batch in batches:
            slot = _slot(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (slot & np.uint64(63))).view(np.int64))],
                names=["word", "bits"])
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    rows = ids.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return words


def perhaps_among(ids: DataFrame, col: str) -> Column:
    """Whether ``col`` (a long, not null) may be one of ``ids`` (one column): true for all that are and, as the bit
    map is of a fixed size, for some that are not."""
    held = ids.sparkSession.sparkContext.broadcast(_asked_map(ids))

    @F.pandas_udf("boolean")
    def marked(x: pd.Series) -> pd.Series:
        slot = _slot(x.to_numpy())
        return pd.Series((held.value[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1)
    return marked(F.col(col))


def least_matches(n_hashes: int, threshold: float, miss: float, batch: int = BATCH) -> list[tuple[int, int]]:
    """(compared, least matches) after each batch: with fewer matches the posterior probability
    of a similarity of ``threshold`` or more is below ``miss``. Prior: uniform; two unlike values
    share their byte once in 256."""
    s = (np.arange(20000) + 0.5) / 20000
    c = s + (1 - s) / 256
    out = []
    for n in [*range(batch, n_hashes, batch), n_hashes]:
        least = 0
        for m in range(n + 1):
            log = m * np.log(c) + (n - m) * np.log1p(-c)
            p = np.exp(log - log.max())
            if p[s >= threshold].sum() / p.sum() >= miss:
                least = m
                break
        out.append((n, least))
    return out


def _alike(x: np.ndarray, y: np.ndarray, least: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the sketches x and y (y may be one row) that no batch rules out, and their matches."""
    alive, matches, done = np.arange(len(x)), np.zeros(len(x), np.int32), 0
    for n, m in least:
        right = y[:, done:n] if len(y) == 1 else y[alive, done:n]
        matches = matches + (x[alive, done:n] == right).sum(axis=1, dtype=np.int32)
        keep = matches >= m
        alive, matches, done = alive[keep], matches[keep], n
        if not len(alive):
            break
    return alive, matches


def _prune_pairs(least: list[tuple[int, int]], width: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, width) for k in (2, 3))
            keep = pa.array(_alike(x, y, least)[0])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])
    return run


def _likeliest(least: list[tuple[int, int]], width: int, num: int, den: int, each: bool):
    """For every outsider of a bucket the likeliest partner outside its component, as far as the
    sketches don't rule all of them out. With ``each`` the likeliest in every other component of
    several texts; and every single text with a single partner, without naming that one (b is null)."""
    def run(block: pa.Table) -> pa.Table:
        doc, comp, n, major = (block.column(c).to_numpy() for c in ("doc_id", "component", "n", "major"))
        asks, single = (block.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "single"))
        sketch = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint8).reshape(-1, width)
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        found_a, found_b = [], []
        marked = np.zeros(len(doc), bool)
        for x in left:
            # of two outsiders the smaller one asks
            turn = (comp[right] == major[right]) | (doc[right] > doc[x])
            if each:   # a single text always asks one of a larger component, and is not asked by it
                turn = np.where(single[right], turn & single[x], turn | single[x])
            y = right[(comp[right] != comp[x]) & turn & (np.minimum(n[right], n[x]) * den >= np.maximum(n[right], n[x]) * num)]
            if len(y):
                alive, matches = _alike(sketch[y], sketch[x: x + 1], least)
                y = y[alive]
                if each:
                    alone = single[y]
                    marked[y[alone]] = True
                    marked[x] |= alone.any()
                    y, matches = y[~alone], matches[~alone]
                order = np.lexsort((doc[y], -matches, comp[y])) if each else np.lexsort((doc[y], -matches))
                _, first = np.unique(comp[y][order], return_index=True)
                y = y[order[first]] if each else y[order[:1]]
                found_a.append(np.full(len(y), doc[x]))
                found_b.append(doc[y])
        cat = lambda p: np.concatenate(p) if p else np.empty(0, np.int64)
        found, lone = cat(found_a), np.unique(doc[marked])
        return pa.table({"key": pa.array(np.full(len(found) + len(lone), block.column("key")[0].as_py()), pa.int64()),
                         "a": pa.array(np.concatenate([found, lone]), pa.int64()),
                         "b": pa.chunked_array([pa.array(cat(found_b), pa.int64()), pa.nulls(len(lone), pa.int64())])})
    return run


def _shared_count(x: np.ndarray, y: np.ndarray) -> int:
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _first_links(least: list[tuple[int, int]], width: int, num: int, den: int):
    """For every asking document one link, if there is one, to the members of a component."""
    def run(block: pa.Table) -> pa.Table:
        doc, n = (block.column(c).to_numpy() for c in ("doc_id", "n"))
        asks = block.column("asks").to_numpy(zero_copy_only=False)
        sketch = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint8).reshape(-1, width)
        sets = [np.frombuffer(x, np.uint64) for x in block.column("shingles").to_pylist()]
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        found = []
        for x in left:
            y = right[np.minimum(n[right], n[x]) * den >= np.maximum(n[right], n[x]) * num]
            if len(y):
                alive, matches = _alike(sketch[y], sketch[x: x + 1], least)
                for k in y[alive[np.argsort(-matches, kind="stable")]]:
                    both = _shared_count(sets[x], sets[k])
                    if both * den >= num * (len(sets[x]) + len(sets[k]) - both):
                        found.append((doc[x], doc[k]))
                        break
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return run


def _single_links(least: list[tuple[int, int]], width: int, num: int, den: int):
    """Links among the single texts of one chunk, or between those of two: all that are needed to join
    what belongs together. Every pair that the sketches don't rule out is compared, unless links of
    the block join it already."""
    def run(block: pa.Table) -> pa.Table:
        doc, n, chunk = (block.column(c).to_numpy() for c in ("doc_id", "n", "mine"))
        within = block.column("i")[0] == block.column("o")[0]
        sketch = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint8).reshape(-1, width)
        sets = [np.frombuffer(x, np.uint64) for x in block.column("shingles").to_pylist()]
        group = np.unique(doc, return_inverse=True)[1]
        found = []
        for x in range(len(doc)):
            y = np.arange(x + 1, len(doc))
            y = y[(group[y] != group[x]) & (within | (chunk[y] != chunk[x]))
                  & (np.minimum(n[y], n[x]) * den >= np.maximum(n[y], n[x]) * num)]
            if len(y):
                alive, matches = _alike(sketch[y], sketch[x: x + 1], least)
                for k in y[alive[np.argsort(-matches, kind="stable")]]:
                    if group[k] == group[x]:
                        continue
                    both = _shared_count(sets[x], sets[k])
                    if both * den >= num * (len(sets[x]) + len(sets[k]) - both):
                        found.append((doc[x], doc[k]))
                        group[group == group[k]] = group[x]
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return run


def _confirm(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = _shared_count(x, y)
                keep.append(both * den >= num * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """Near-duplicate classes: one row (doc_id, n_shingles, component_id, kept) per input row.

    ``component_id`` is the smallest id reachable over links of Jaccard similarity ``threshold`` or
    more between shingle sets; ``kept`` marks the document that stands for its component.

    Defined cases: null or blank text has no shingles and no links. A row without an id is
    returned unlinked (null component) and kept. Rows that share an id are one node; equal sets
    are one class whatever their number. An empty table gives an empty result. Other columns of
    ``docs`` play no part.

    Scale: copies collapse by a set fingerprint with map-side combine, so a bucket holds different
    texts only. Candidates are tried in rounds, each followed by connected components: every text
    with one bucket mate; in buckets that still hold several components, one text of each with the
    bucket's smallest; texts outside a bucket's largest component with their likeliest partner in
    other components; and at last such texts with all members of the components that hold a likely
    partner, and the texts still single with all single ones of their buckets, whose sets are compared
    in the task. Pairs inside a component need no test. Blocks of bounded size meet inside tasks, so
    no bucket is emitted as all its pairs and none is capped.
    The heavy joins are merge joins at every size, which adaptive execution splits where a key is hot.
    """
    level = Fraction(str(threshold))
    num, den = level.numerator, level.denominator
    width = bands * rows
    least = least_matches(width, float(threshold), miss)
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    feat = materialize(src.mapInArrow(_features(shingle_words, bands, rows), FEATURES), "minhash")
    some = feat.filter("n > 0 and doc_id is not null")

    band = some.select("fp1", F.explode("bands").alias("key"))
    shared = band.groupBy("key").agg(F.min("fp1").alias("lo"), F.max("fp1").alias("hi")).filter("lo <> hi").select("key", "lo")
    bucket = materialize(band.join(shared.hint("merge"), "key").distinct(), "buckets")
    mates = bucket.select("fp1").distinct()
    node = materialize(some.select("fp1", "doc_id", "n", "sketch").join(mates.hint("merge"), "fp1", "left_semi")
                       .groupBy("fp1").agg(F.min(F.struct("doc_id", "n", "sketch")).alias("x")).select("fp1", "x.*"), "texts")
    asked = spark.sparkContext.broadcast(_asked_map(node.select("doc_id")))
    named = src.filter("doc_id is not null").mapInArrow(_sets(shingle_words, asked), "doc_id long, shingles binary")
    sets = materialize(named, "sets")

    def linked(candidates: DataFrame, label: str) -> DataFrame:
        """Candidate pairs (a, b) of ids that reach the threshold on their full sets."""
        def side(x: str, to: str) -> DataFrame:
            return sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(to)).hint("merge")
        both = candidates.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
        with arrow_rows(spark, 500):
            return materialize(both.mapInArrow(_confirm(num, den), "a long, b long").distinct(), f"links-{label}")

    def alike(pairs: DataFrame, label: str) -> DataFrame:
        """Pairs (a, b) of fingerprints that the sketches don't rule out, as pairs of ids."""
        def side(x: str, i: str, n: str, s: str) -> DataFrame:
            return node.select(F.col("fp1").alias(x), F.col("doc_id").alias(i), F.col("n").alias(n), F.col("sketch").alias(s)).hint("merge")
        sized = (pairs.join(side("a", "ia", "na", "sa"), "a").join(side("b", "ib", "nb", "sb"), "b")
                 .filter(F.least("na", "nb") * F.lit(den) >= F.greatest("na", "nb") * F.lit(num)).select("ia", "ib", "sa", "sb"))
        return materialize(sized.mapInArrow(_prune_pairs(least, width), "a long, b long"), f"alike-{label}")

    def placed(labels: DataFrame) -> DataFrame:
        """Bucket members with their ids and components so far; labels hold no single texts."""
        ids = node.select("fp1", "doc_id", "n")
        return (bucket.join(ids, "fp1").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                .select("key", "fp1", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"),
                        F.col("component").isNull().alias("single")))

    first = bucket.filter("fp1 <> lo").groupBy("fp1").agg(F.min("lo").alias("a")).select("a", F.col("fp1").alias("b"))
    links = linked(alike(first, "first"), "first")
    labels = connected_components(links)

    members = placed(labels)
    heads = members.groupBy("key", "component").agg(F.min(F.struct("doc_id", "fp1")).alias("head"))
    top = heads.groupBy("key").agg(F.min(F.struct("head", "component")).alias("top"), F.count("*").alias("parts")).filter("parts > 1")
    second = (heads.join(top, "key").filter(F.col("component") != F.col("top.component"))
              .select(F.col("top.head.fp1").alias("a"), F.col("head.fp1").alias("b")).distinct())
    more = linked(alike(second, "heads"), "heads")
    if more.limit(1).count():
        links = links.unionByName(more)
        labels = connected_components(links)

    def dealt(df: DataFrame, asks: bool, mine: str, other: str, *cols: str) -> DataFrame:
        """Own chunk by id, and a copy for every chunk of the other side."""
        return df.select(*cols, F.lit(asks).alias("asks"), F.pmod(F.xxhash64("doc_id"), F.col(mine)).alias(mine[0]),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[0]))

    def chunks(size):
        return F.ceil(size / CHUNK).cast("long")

    def likeliest(members: DataFrame, each: bool) -> DataFrame:
        """(key, a, b): texts outside their bucket's largest component and their likeliest partners."""
        parts = members.groupBy("key", "component").agg(F.count("*").alias("size"), F.min(~F.col("single")).alias("several"))
        mixed = (parts.groupBy("key").agg(F.max(F.struct("several", "size", "component")).alias("big"), F.sum("size").alias("total"), F.count("*").alias("parts"))
                 .filter("parts > 1 and total > 2")
                 .select("key", F.col("big.component").alias("major"), chunks(F.col("total")).alias("all"),
                         chunks(F.col("total") - F.col("big.size")).alias("out")))
        rest = members.join(mixed, "key").join(node.select("fp1", "sketch"), "fp1")
        cols = ("key", "major", "doc_id", "component", "single", "n", "sketch")
        blocks = dealt(rest, False, "all", "out", *cols).unionByName(dealt(rest.filter("component <> major"), True, "out", "all", *cols))
        return materialize(blocks.groupBy("key", "a", "o").applyInArrow(_likeliest(least, width, num, den, each), "key long, a long, b long"), "likeliest")

    third = linked(likeliest(materialize(placed(labels), "members"), False).select("a", "b").distinct(), "likeliest")
    if third.limit(1).count():
        links = links.unionByName(third)
        labels = connected_components(links)

    # what is left: a text against all members of a component that holds a likely partner of it
    members = materialize(placed(labels), "members")
    text = materialize(members.select("doc_id", "n", "fp1", "component").distinct(), "placed")
    likely = likeliest(members, True)
    asking = (likely.filter("b is not null").select("a", "b").distinct().join(text.select(F.col("doc_id").alias("b"), "component"), "b")
              .select(F.col("a").alias("doc_id"), "component").distinct())
    sizes = text.groupBy("component").agg(F.count("*").alias("size"))
    sides = (asking.groupBy("component").agg(F.count("*").alias("askers")).join(sizes, "component")
             .select("component", chunks(F.col("size")).alias("all"), chunks(F.col("askers")).alias("out")))
    known = node.select("fp1", "sketch")
    cols = ("component", "doc_id", "n", "sketch", "shingles")
    askers = asking.join(sides, "component").join(text.select("doc_id", "n", "fp1"), "doc_id").join(known, "fp1").join(sets, "doc_id")
    asked_of = text.join(sides, "component").join(known, "fp1").join(sets, "doc_id")
    blocks = dealt(asked_of, False, "all", "out", *cols).unionByName(dealt(askers, True, "out", "all", *cols))
    last = materialize(blocks.groupBy("component", "a", "o").applyInArrow(_first_links(least, width, num, den), "a long, b long").distinct(), "last")

    # and single texts that have likely partners among the single ones of a bucket: all of them against each other
    lone = likely.filter("b is null").select("key", F.col("a").alias("doc_id")).distinct()
    dealing = lone.groupBy("key").agg(chunks(F.count("*")).alias("all"))
    meeting = (lone.join(dealing, "key").join(text.select("doc_id", "n", "fp1"), "doc_id").join(known, "fp1").join(sets, "doc_id")
               .select("key", "doc_id", "n", "sketch", "shingles", F.pmod(F.xxhash64("doc_id"), F.col("all")).alias("mine"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)).alias("other"))
               .withColumn("i", F.least("mine", "other")).withColumn("o", F.greatest("mine", "other")).drop("other"))
    alone = materialize(meeting.groupBy("key", "i", "o").applyInArrow(_single_links(least, width, num, den), "a long, b long").distinct(), "alone")
    last = last.unionByName(alone)
    if last.limit(1).count():
        labels = connected_components(links.unionByName(last))

    copies = (some.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
              .filter("rep <> last").drop("last"))
    out = (feat.select("doc_id", "n", "fp1", "fp2").join(copies, ["fp1", "fp2", "n"], "left")
           .withColumn("node", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))).join(labels, "node", "left"))
    return (out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
