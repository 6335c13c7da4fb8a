"""Line deduplication, in DataFrame functions only.

Lines are exploded with their position and hashed; per hash the distinct documents are counted; the lines of hashes in
enough documents are dropped but in the smallest document; the rest is put together again by position. Line texts
are never shuffled, only two 64-bit hashes, the document and the position; a frequent line is first combined per
document and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import BLANKS, lower_az, whole_text


RESULT = ("kept_text", "n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    return lower_az(F.btrim(line, F.lit(BLANKS)))


def dropped_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """(doc_id, text_hash, drop): positions of the lines that go, for documents that lose any.

    A line goes if its key has at least `min_chars` code points and lies in at least `min_docs` documents, this one not
    being the smallest of them. Repeated rows of one doc_id are one document. Null ids are one document after all others.
    """
    lines = (
        docs.select("doc_id", F.xxhash64("__text").alias("__th"), F.posexplode(F.split("__text", "\n", -1)).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.length("key") >= min_chars)
        .select("doc_id", "__th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))
    )
    per_document = lines.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    shared = (
        per_document.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", F.xxhash64("h1", "h2").alias("h3"), "first_doc")
    )
    # The third key makes the join deal both sides anew: only then can adaptive execution split a very frequent line.
    return (
        lines.withColumn("h3", F.xxhash64("h1", "h2"))
        .join(shared, ["h1", "h2", "h3"])
        .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .groupBy("doc_id", "__th")
        .agg(F.collect_set("pos").alias("drop"))
    )


def line_dedup(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """All columns of `docs` plus `kept_text`, `n_lines` (before) and `n_dropped`, which replace columns of these names.

    A null or empty text is one empty line. If all lines go, the kept text is empty. Repeated rows get equal results;
    an empty frame gives an empty one.
    """
    source = docs.withColumn("__text", whole_text(F.col("text"))).withColumn("__th", F.xxhash64("__text"))
    drops = dropped_lines(source, min_chars, min_docs).select(F.col("doc_id").alias("__id"), F.col("__th").alias("__dh"), F.col("drop").alias("__drop"))
    own = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("__dh"))
    lines = F.split("__text", "\n", -1)
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drop")), lambda i: F.get(F.col("__lines"), i)
    )
    return (
        source.join(drops, own, "left")
        .withColumn("__lines", lines)
        .withColumn("kept_text", F.when(F.col("__drop").isNull(), F.col("__text")).otherwise(F.array_join(kept, "\n")))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size("__drop"), F.lit(0)).cast("long"))
        .select(*(c for c in docs.columns if c not in RESULT), *RESULT)
    )
