"""Replace-into semantics on DataFrames: last write per key, change labels, list pushes, documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(batch: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The row with the greatest order value per key.

    An aggregate rather than a ranking: rows are combined before the shuffle, so a key written very
    often is no hot task. Columns after the order break ties, so equal orders give one definite row.
    """
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in batch.columns if c not in keys and c not in order]
    last = batch.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("last"))
    return last.select(*[c if c in keys else F.col(f"last.{c}").alias(c) for c in batch.columns])


def _same_key(keys: Sequence[str], names: Sequence[str]) -> Column:
    """Null keys are keys like any other."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])


def _against(rows: DataFrame, known: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    names = [f"__known_{i}" for i in range(len(keys))]
    return rows.join(known.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]), _same_key(keys, names), how)


def absent(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among those of `known`, null keys included."""
    return _against(rows, known, keys, "left_anti")


def present(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is among those of `known`, null keys included."""
    return _against(rows, known, keys, "left_semi")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Target rows without a new version, and the last new version of every key in the batch."""
    latest = last_per_key(batch, keys, order)
    names = [f"__new_{i}" for i in range(len(keys))]
    new_keys = latest.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    kept = target.join(new_keys, _same_key(keys, names), "left_anti")
    return kept.select(*batch.columns).unionByName(latest)


def change_label(target: DataFrame, batch: DataFrame, keys: Sequence[str], label: str = "change") -> DataFrame:
    """Batch rows labelled `insert` for a new key, `update` or `same` against the target's row."""
    rest = [c for c in batch.columns if c not in keys]
    names = [f"__old_{i}" for i in range(len(keys))]
    old = target.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.struct(*rest).alias("__old"))
    return (
        batch.join(old, _same_key(keys, names), "left")
        .withColumn(
            label,
            F.when(F.col("__old").isNull(), "insert")
            .when(F.struct(*rest).eqNullSafe(F.col("__old")), "same")
            .otherwise("update"),
        )
        .drop("__old", *names)
    )


def documents(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """One JSON document per row with every value as text, for a search index."""
    renames = renames or {}
    values = [F.col(c).cast("string").alias(renames.get(c, c)) for c in df.columns]
    return df.select(F.to_json(F.struct(*values)).alias("document"))


def list_pushes(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Push commands for a key-value list: key, value text, and what orders the pushes of one key.

    The list itself is never built here: one key's list grows with the stream.
    """
    return df.select(
        F.col(key).cast("string").alias("list_key"), F.col(value).cast("string").alias("list_value"), order
    )
