"""SimHash fingerprints and permuted-table search, in DataFrame functions only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._common import materialize

BITS = 64
LANES = 0x0000000100000001      # two 32-bit counters in one long
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
DOCS_PER_BLOCK, MAX_BLOCKS, SPLITS = 2000, 1_000_000, 4


def _with_terms(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` and one row per term: (h, w), the hash and weight of every adjacent pair of lower-cased
    words (a lone word by itself). The weight is the pair's letters, so that pairs of short common
    words say little. Text without words gives one row of nulls."""
    words = df.select(*keys, F.array_remove(F.split(F.lower(F.col(text_col)), r"[\x20\x09-\x0D]+"), "").alias("words"))

    def term(x: Column, y: Column) -> Column:
        return F.struct(F.xxhash64(x, y).alias("h"), (F.length(x) + F.length(y)).cast("long").alias("w"))

    n = F.size("words")
    pairs = F.zip_with(F.slice("words", 1, F.greatest(n - 1, F.lit(0))), F.slice("words", 2, F.greatest(n - 1, F.lit(0))), term)
    lone = F.transform(F.col("words"), lambda x: term(x, F.lit("")))
    return (words.select(*keys, F.explode_outer(F.when(n == 1, lone).otherwise(pairs)).alias("t"))
            .select(*keys, F.col("t.h").alias("h"), F.col("t.w").alias("w")))


def _votes(h: Column, w: Column) -> list[Column]:
    """Weighted ones of bits j and j + 32 in the halves of one sum; and the sum of all weights."""
    return [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANES)) * w).alias(f"v{j}") for j in range(32)] + [F.sum(w).alias("all")]


def _from_votes() -> Column:
    """Bit set where the ones weigh more than half."""
    bits = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"v{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"v{j}"), 32)
        bits = bits.bitwiseOR(F.when(low * 2 > F.col("all"), F.lit(1 << j)).otherwise(F.lit(0)).cast("long"))
        top = (1 << (j + 32)) - (1 << 64 if j == 31 else 0)
        bits = bits.bitwiseOR(F.when(high * 2 > F.col("all"), F.lit(top)).otherwise(F.lit(0)).cast("long"))
    return F.coalesce(bits, F.lit(0).cast("long"))


def fingerprint(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint`` (long), one row per distinct ``keys``; text without words gives 0.

    Terms are exploded and their votes summed by Spark's hash aggregate, which combines within
    the task that read the text, so a document's terms never move.
    """
    return _with_terms(df, keys, text_col).groupBy(*keys).agg(*_votes(F.col("h"), F.col("w"))).select(*keys, _from_votes().alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def block_tables(fp: Column, radius: int, widths: tuple[int, ...] = BLOCK_BITS) -> Column:
    """Array of table keys. Bits are cut into blocks; each table permutes some blocks to the
    front as its key. Two fingerprints within ``radius`` agree in all but ``radius`` blocks, so they
    share a key in one table at least."""
    if sum(widths) != BITS or radius >= len(widths):
        raise ValueError("block widths must add up to 64 and outnumber the radius")
    starts = [sum(widths[:i]) for i in range(len(widths))]
    block = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << b) - 1)) for s, b in zip(starts, widths, strict=True)]
    tables = []
    for t, chosen in enumerate(combinations(range(len(widths)), len(widths) - radius)):
        tables.append(F.xxhash64(F.lit(t), *(block[i] for i in chosen)))
    return F.array(*tables)


def search(fps: DataFrame, queries: DataFrame, radius: int = 3, fp_col: str = "fingerprint",
           widths: tuple[int, ...] = BLOCK_BITS) -> DataFrame:
    """All pairs (query_fp, fp, distance) of distinct fingerprints of ``queries`` and ``fps`` within
    ``radius`` bits, the query's own included. Equal fingerprints count once: join memberships
    afterwards. Null fingerprints match nothing."""
    def keyed(df: DataFrame, name: str) -> DataFrame:
        return (df.select(F.col(fp_col).alias(name)).filter(F.col(name).isNotNull()).distinct()
                .select(name, F.explode(block_tables(F.col(name), radius, widths)).alias("key")))
    near = keyed(queries, "query_fp").join(keyed(fps, "fp"), "key")
    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp")))
    return near.select("query_fp", "fp", distance.cast("int").alias("distance")).filter(F.col("distance") <= radius).distinct()


def _text_place(text: Column) -> Column:
    """A number that falls as texts rise: of their first six bytes."""
    return -F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")


def _blocked(d: DataFrame, docs_per_block: int) -> DataFrame:
    """(doc_id, text) with ``block``, an array of numbers whose descending order is that of the documents.

    Ids are cut into blocks of equal width first, null ids being one block. A block with too many
    rows is cut again by the width of its own ids, or of its texts' first bytes where it has one id,
    so neither a far-out id nor dense runs, repeated or null ids fill a block. Only counts are
    taken for it, from the id column or a few bytes of the texts; the blocks that are cut (at most
    ``MAX_BLOCKS`` in a round) are broadcast to the rows.
    """
    x, y = F.col("doc_id").cast("double"), _text_place(F.col("text"))
    span = d.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, per_block = span["lo"] or 0.0, max(docs_per_block, -(-span["n"] // MAX_BLOCKS))
    width = max(((span["hi"] or 0.0) - lo) / max(1, -(-span["n"] // per_block)), 1.0)
    d = d.withColumn("block", F.array(F.coalesce(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(-1)).cast("long")))
    for _ in range(SPLITS):
        sizes = d.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("x0"), F.max(x).alias("x1")).filter(F.col("n") > 2 * per_block)
        wide = sizes.filter("x0 < x1").select("block", "n", F.lit(True).alias("by_id"), F.col("x0").alias("start"), F.col("x1").alias("end"))
        flat = (d.join(F.broadcast(sizes.filter("x0 is null or x0 >= x1").select("block")), "block", "left_semi")
                .groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min(y).alias("start"), F.max(y).alias("end"))
                .select("block", "n", F.lit(False).alias("by_id"), "start", "end").filter("start < end"))
        cut = materialize(wide.unionByName(flat).select(F.col("block").alias("of"), "by_id", "start", F.ceil(F.col("n") / per_block).alias("parts"),
                          ((F.col("end") - F.col("start")) / F.ceil(F.col("n") / per_block)).alias("width")), "cut")
        if not cut.limit(1).count():
            break
        part = F.least(F.floor((F.when(F.col("by_id"), x).otherwise(y) - F.col("start")) / F.col("width")).cast("long"), F.col("parts") - 1)
        d = (d.join(F.broadcast(cut), F.col("block") == F.col("of"), "left")
             .withColumn("block", F.concat("block", F.array(F.coalesce(part, F.lit(0).cast("long"))))).select("doc_id", "text", "block"))
    return d


def successor_texts(docs: DataFrame, id_col: str, text_col: str, docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """(block, row, extra, doc_id, text, next_id, next_text) with the next document in descending id order;
    after the last comes the first. Texts are shuffled once: ids are cut into blocks by rows, each
    block gets the following block's first document as a row with ``extra`` = 1, and ``lead`` works
    inside blocks. What is broadcast has a row per block, of which there are a few ``MAX_BLOCKS`` at most."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = _blocked(d, docs_per_block)
    place = _text_place(F.col("text"))
    heads = d.groupBy("block").agg(F.max(F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), place.alias("place"))).alias("head"))
    down = Window.orderBy(F.col("block").desc())  # over the blocks
    # a block's head follows the last document of the block above it; the top block's, the lowest one's
    pairs = heads.select("head", F.coalesce(F.lag("block").over(down), F.min("block").over(Window.partitionBy())).alias("target"), F.col("block").alias("of"))
    extra = (d.join(F.broadcast(pairs), (F.col("block") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (place == F.col("head.place")))
             .select("doc_id", "text", F.col("target").alias("block"), F.lit(1).alias("extra")))
    rows = d.select("doc_id", "text", "block", F.lit(0).alias("extra")).unionByName(extra)
    w = Window.partitionBy("block").orderBy("extra", F.col("doc_id").desc_nulls_last(), "text")
    return (rows.withColumn("row", F.row_number().over(w)).withColumn("next_id", F.lead("doc_id").over(w))
            .withColumn("next_text", F.lead("text").over(w)))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3,
                      query_step: int = 100) -> DataFrame:
    """Fingerprints of every text, of its edited text (last third replaced by the start of the next
    document) and their likeness, and for ids divisible by ``query_step`` the number of other
    rows within ``radius`` bits (``near_docs``, else null).

    Defined cases: null text is empty and has fingerprint 0; a null id sorts last; repeated ids
    follow one another by text; a single document is its own successor; an empty table gives none.
    """
    s = successor_texts(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.expr("concat(substring(text, 1, cast(n_chars - floor(n_chars / 3) as int)), "
                    "substring(coalesce(next_text, ''), 1, cast(floor(n_chars / 3) as int)))")
    s = s.withColumn("edited", edited).withColumn("sha", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    keys = ["block", "row", "extra", "doc_id", "n_chars", "sha"]
    both = s.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
                                             F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("x"))
    fps = fingerprint(both.select(*keys, "x.which", F.col("x.t").alias("t")), [*keys, "which"], "t")
    fps = fps.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fp"),
                                 F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fp"))
    fps = fps.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("block").orderBy("row"))).filter("extra = 0")
    fps = materialize(fps.select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fp", "edited_fp", "next_fp"), "simhash")

    sizes = fps.groupBy("fp").agg(F.count("*").alias("size"))
    asked = fps.filter(F.pmod("doc_id", F.lit(query_step)) == 0)
    near = (search(fps.withColumnRenamed("fp", "fingerprint"), asked.withColumnRenamed("fp", "fingerprint"), radius)
            .join(sizes, "fp").groupBy("query_fp").agg((F.sum("size") - 1).alias("near_docs")))
    counts = asked.select("doc_id", "fp").distinct().join(near.withColumnRenamed("query_fp", "fp"), "fp")
    out = fps.join(counts, ["doc_id", "fp"], "left")
    return out.select("doc_id", "n_chars", "edited_sha256", hex16(F.col("fp")).alias("fingerprint"),
                      hex16(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                      likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "near_docs")
