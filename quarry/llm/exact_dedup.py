"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts count as equal when they are identical without white space. A level's keys that occur more
than once are marked in a bit table of fixed size, and only rows whose key is marked go on to the
next, dearer level: the length needs no hash, the prefix hash reads some characters of texts whose
length occurs again, and the full hash reads whole texts only where length and prefix occur again.
A bit that several keys share lets more rows through, never fewer. No text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._common import materialize

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"
PREFIX_CHARS = 64      # characters of the second level
TABLE_BITS = 1 << 25   # bits of a level's table: 4 MB, whatever the input
HEAVY_SHARE = 1000     # groups of at least one in so many rows are joined apart: at most that many


def normalised(text: Column) -> Column:
    """``text`` without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, "")


def _bit(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(TABLE_BITS))


def repeated_keys(rows: DataFrame, *key: str) -> DataFrame:
    """(bucket, bits): a table of ``TABLE_BITS`` bits in rows of 4 KB, a bit set for every key that
    more than one row has. Keys are counted in the tasks before they are shuffled."""
    again = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(_bit(*map(F.col, key)).alias("__bit"))
    return again.groupBy(F.bitmap_bucket_number("__bit").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__bit")).alias("__bits"))


def marked(rows: DataFrame, bits: DataFrame, out: str, *key: str) -> DataFrame:
    """``rows`` with ``out``: whether the bit of the row's key is set. The table is broadcast: it has
    at most ``TABLE_BITS`` / 32,768 rows of 4 KB."""
    at = _bit(*map(F.col, key))
    byte = F.substring("__bits", (F.bitmap_bit_position(F.col("__at")) / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.pmod(F.bitmap_bit_position(F.col("__at")), F.lit(8)).cast("int")) == 1
    return (rows.withColumn("__at", at).join(F.broadcast(bits), F.bitmap_bucket_number(F.col("__at")) == F.col("__bucket"), "left")
            .withColumn(out, F.coalesce(is_set, F.lit(False))).drop("__at", "__bucket", "__bits"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS,
                     digest_all: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``, dropped ones too.

    Of rows with equal normalised texts the one with the most code points in its original text
    stays, then the one of the smallest id, a null id last; of rows that share all of these exactly
    one. Null text is empty, and texts without anything but white space are one group; an empty
    table gives none; other columns play no part. ``text_sha256`` (hex, of the normalised text) is
    null for rows that no other row can equal, unless ``digest_all`` asks for it.

    The texts are scanned once per level and not shuffled or copied; what is shuffled is a key per
    row. Groups that hold at least one in ``HEAVY_SHARE`` of the rows, of which there are no more
    than that many, are broadcast to their rows; the others are joined.
    """
    name = lambda c: F.col("`" + c.replace("`", "``") + "`")
    src = docs.select(name(id_col).cast("long").alias("doc_id"), name(text_col).cast("string").alias("text"))
    body = src.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"), normalised(F.col("text")).alias("body"))
    sized = body.withColumn("size", F.length("body"))

    lengths = materialize(repeated_keys(sized, "size"), "lengths")
    first = marked(sized, lengths, "again", "size")
    prefixed = lambda df: df.withColumn("prefix", F.when(F.col("again"), F.xxhash64(F.substring("body", 1, prefix_chars))))

    prefixes = materialize(repeated_keys(prefixed(first).filter("again").select("size", "prefix"), "size", "prefix"), "prefixes")
    second = marked(prefixed(first), prefixes, "likely", "size", "prefix").withColumn("likely", F.col("again") & F.col("likely"))

    digest = F.sha2("body", 256)
    slim = materialize(second.select("doc_id", "chars", "likely", F.monotonically_increasing_id().alias("row"),
                                     (digest if digest_all else F.when(F.col("likely"), digest)).alias("sha")), "digests")
    rows = slim.count()   # of a written table: its files' footers

    # the row that stays is the greatest of these: an inverted number is smaller where the number is greater
    rank = F.struct("chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row"))
    groups = materialize(slim.filter("likely").groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), F.max(rank).alias("best"))
                         .filter("group_size > 1")
                         .select(F.col("sha").alias("group_sha"), "group_size", F.bitwise_not("best.id").alias("keep_id"), F.bitwise_not("best.row").alias("keep_row")), "groups")
    heavy = F.col("group_size") * HEAVY_SHARE >= rows
    out = slim.join(F.broadcast(groups.filter(heavy)), F.col("likely") & (F.col("sha") == F.col("group_sha")), "left")
    in_heavy, alone = out.filter("group_sha is not null"), out.filter("group_sha is null").drop("group_sha", "group_size", "keep_id", "keep_row")
    rest = (alone.filter("likely").join(groups.filter(~heavy), F.col("sha") == F.col("group_sha"), "left")
            .unionByName(alone.filter(~F.col("likely")), allowMissingColumns=True))
    whole = in_heavy.unionByName(rest)
    single = F.col("group_sha").isNull()
    return whole.select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                        (single | (F.col("row") == F.col("keep_row"))).alias("kept"), F.col("sha").alias("text_sha256"))
