"""A corpus pipeline of four stages over ``documents``.

Language ID rejects documents that are in no learned language, near-dedup keeps one document of each
group, the secret scan redacts, and packing gives the pieces of training sequences. Each stage's
result is written as Parquet in the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import langid, near_dedup, packing, secrets
from quarry.llm._common import materialize, scratch_path, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the profiles from the documents not held out and keeps the documents in one of their languages;
    null texts, texts without a letter and texts whose rank-order score is below the floor that the
    labelled documents set (``langid.score_floor``) go."""
    return langid.identified(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8) stays, the one
    of the smallest id. Rows are told apart by a number of their own, not by their ids: rows that
    share an id, or have none, go if their texts are linked and stay if they are not; of equal rows
    one stays. Only rows that a bit map takes for dropped ones are joined with those: the other texts
    are not shuffled."""
    rows = materialize(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    classes = near_dedup.near_duplicates(rows, id_col="row").filter("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id")
    several = materialize(classes.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
                          .join(classes, "component_id").join(rows.select("row", "doc_id"), "row"), "several")
    stays = several.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row"))
    gone = materialize(several.join(stays.select("row"), "row", "left_anti").select("row"), "gone")
    marked = rows.withColumn("perhaps", near_dedup.perhaps_among(gone, "row"))
    checked = marked.filter("perhaps").join(gone.hint("merge"), "row", "left_anti")
    return marked.filter("not perhaps").select(*COLUMNS).unionByName(checked.select(*COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark."""
    return secrets.redact_secrets(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("packing", pack)]

#: The stages tokenize, hash and compare texts; SQL cannot express them (see tests/llm for brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
