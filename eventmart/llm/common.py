"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# The white space of all word and line rules: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """A-Z lower-cased and nothing else. ASCII texts take the quick built-in; others are translated by letter."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def whole_text(text: Column) -> Column:
    """The text as the operators read it: null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def fold(doc_id: Column, folds: int) -> Column:
    """Fold of a document by its id as text; a null id lies in fold 0 of the crc32 of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
