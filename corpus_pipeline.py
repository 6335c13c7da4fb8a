"""From raw documents to packed training sequences: five stages, each one of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import exact_dedup, near_dup, packing, pareto_mix, toxicity
from eventmart.llm.common import table
from eventmart.llm.queries import tokenizer_path
from eventmart.session import written

# No SQL: trained machine, signatures and tokenizer have no SQL form. Tests hold the rows against brute force.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a machine trained on all labels of these documents does not call toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learned=F.lit(True))
    return toxicity.drop_toxic(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one of the largest doc_id."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8), the one of the smallest doc_id."""
    return near_dup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Each row carries its own copies, as ids may be null or repeated. Rows of a null id are told apart by their texts.
    """
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("__row"))
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.col("text").cast("binary"))))
    taken = pareto_mix.mix(rows, key=named).where("taken > 0")
    copies = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return taken.select("__row", F.explode(copies).alias("__nth")).select("__row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dup", without_near_copies),
    ("mix", mixed),
    ("pack", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and reread before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
