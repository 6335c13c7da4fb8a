"""Exact deduplication by skew-safe combining.

Three combining stages, each grouping on the digest *and* the whole content, so that a digest that two texts share
never merges them: (1) within each input partition, before anything is shuffled; (2) per digest and salt, the salt
being that of the input partition, so that copies of one text spread over as many tasks as there are salts;
(3) the winners of the salts per digest. Between the stages a text of n copies is at most one row per partition, then
at most one row per salt. No list of members is ever built: rows find their group again by SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import lower_az, whole_text

SALTS = 32


def content_groups(rows: DataFrame, digest: str, content: str, order: str, salts: int = SALTS) -> DataFrame:
    """Groups of equal `content`: digest, content, the greatest `order` and the number of rows.

    A null `order` loses against any other; in a group of nulls alone the result is null. An empty frame gives none.
    """
    dealt = rows.select(
        F.col(digest).alias("digest"),
        F.col(content).alias("content"),
        F.col(order).alias("top"),
        (F.spark_partition_id() % salts).alias("salt"),
    )
    # The first grouping has its local stage in Spark's map-side combine: same keys, before the shuffle.
    salted = dealt.groupBy("digest", "salt", "content").agg(F.max("top").alias("top"), F.count(F.lit(1)).alias("size"))
    return salted.groupBy("digest", "content").agg(F.max("top").alias("top"), F.sum("size").alias("size"))


def hashed(docs: DataFrame, text: Column) -> DataFrame:
    """All columns of `docs`, with the normalised text and its SHA-256 under names that cannot clash."""
    return docs.withColumn("__norm", lower_az(whole_text(text))).withColumn("__sha", F.unhex(F.sha2("__norm", 256)))


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null is empty, and all empty texts are equal. The greatest
    doc_id of a group stays. A repeated row (same id, equal text) counts in group_size, and each of its copies has
    kept = true, as they are one document. A null doc_id stays only if all of its group are null. Other columns are ignored.
    """
    rows = hashed(docs.select("doc_id", "text"), F.col("text"))
    groups = content_groups(rows, "__sha", "__norm", "doc_id", salts).select(
        F.col("digest").alias("__sha"), F.col("top").alias("keep_id"), F.col("size").alias("group_size")
    )
    return (
        rows.select("doc_id", "__sha")
        .join(groups, "__sha")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("__sha")).alias("text_sha256"),
        )
    )


def keep_one(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of `docs` that stay, all columns: one of each group, also of repeated rows."""
    rows = hashed(docs, F.col("text"))
    winners = content_groups(rows, "__sha", "__norm", "doc_id", salts).select(
        F.col("digest").alias("__digest"), F.col("top").alias("__top")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__top")) & (F.col("__sha") == F.col("__digest"))
    # Joined by id and digest, a group of copies is spread over all tasks, and only its winners meet the window.
    one = Window.partitionBy("__sha", "doc_id").orderBy(*sorted(c for c in docs.columns if c != "text"))
    return (
        rows.drop("__norm")
        .join(winners, same, "left_semi")
        .withColumn("__nth", F.row_number().over(one))
        .where("__nth = 1")
        .select(*docs.columns)
    )
