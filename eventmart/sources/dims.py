"""Dimension snapshots: key-value hashes, relational tables, and how one snapshot follows another."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORG_COLUMNS = ("dept_name", "busi_area_code", "busi_area_name", "admin_area_code", "admin_area_name")


def org_dimension(raw: DataFrame, key: str = "k", value: str = "v") -> DataFrame:
    """`code -> "name,area,..."` entries as columns, with the number of attributes found.

    Trailing empty attributes do not count, so `"a,b,,"` has two.
    """
    parts = F.split(F.regexp_replace(F.col(value), ",+$", ""), ",")
    split = raw.select(F.col(key).alias("org_code"), parts.alias("parts"))
    return split.select(
        "org_code",
        *[F.get("parts", F.lit(i)).alias(name) for i, name in enumerate(ORG_COLUMNS)],
        F.size("parts").alias("n_attrs"),
    )


def area_dimension(raw: DataFrame, key: str = "k", value: str = "v") -> DataFrame:
    """`area -> "country,country"` entries turned round: one row per country and area that names it.

    Trailing empty countries do not count. Where two areas name a country, `dimension` settles on one.
    """
    countries = F.split(F.regexp_replace(F.col(value), ",+$", ""), ",")
    return raw.select(F.explode(countries).alias("country"), F.col(key).alias("area"))


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    query: str,
    partition: Mapping[str, str] | None = None,
) -> DataFrame:
    """A query's snapshot over JDBC. Connection options (url, user, driver) come from the caller.

    `partition` may hold partitionColumn, lowerBound, upperBound and numPartitions, so that a large
    dimension is read by many tasks.
    """
    reader = spark.read.format("jdbc").options(**options)
    if partition:
        return reader.options(dbtable=f"({query}) snapshot", **partition).load()
    return reader.option("query", query).load()


def load_function_dim(spark: SparkSession, options: Mapping[str, str], table: str, **kwargs) -> DataFrame:
    return read_jdbc(spark, options, f"select func_id, func_name from {table}", **kwargs)


def load_user_dim(spark: SparkSession, options: Mapping[str, str], table: str, **kwargs) -> DataFrame:
    return read_jdbc(spark, options, f"select user_id, user_name from {table} where user_id is not null", **kwargs)


def keep_if_empty(old: DataFrame, new: DataFrame) -> DataFrame:
    """An empty snapshot is taken as a failed read: the old one stays."""
    return old if new.isEmpty() else new


def replace_snapshot(old: DataFrame, new: DataFrame) -> DataFrame:
    """The new snapshot alone: keys it lacks are gone."""
    return keep_if_empty(old, new)


def merge_snapshot(old: DataFrame, new: DataFrame, on: str | list[str]) -> DataFrame:
    """Keys of the new snapshot win, keys only the old one has stay."""
    return new.unionByName(old.join(new, on, "left_anti"))
