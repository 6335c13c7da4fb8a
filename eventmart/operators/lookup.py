"""Equi lookup of facts in a dimension with one row per key.

A dimension whose measured size is below the bound is broadcast: the facts do not move. Beyond it
the join is shuffled, with the most frequent keys of the facts (where a shuffle would pile up on one
task) split off and matched by a broadcast of just their dimension rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 5_000


@dataclass(frozen=True)
class Dimension:
    """A snapshot with its key columns and whether it was measured to fit a broadcast."""

    frame: DataFrame
    on: tuple[str, ...]
    small: bool

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.frame.columns if c not in self.on]


def dimension(
    frame: DataFrame,
    on: str | list[str],
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> Dimension:
    """Measure the snapshot once (counts and a byte sum, no row leaves the executors), and give each key one row.

    Where a key has several rows, the one with the greatest attributes stays, compared in column order, so that every
    lookup path gives a fact the same single row.
    """
    keys = (on,) if isinstance(on, str) else tuple(on)
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in frame.columns],
    )
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    size = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(width.cast("bigint")).alias("bytes"),
        F.count(F.when(whole, 1)).alias("keyed"),
        F.count_distinct(*keys).alias("keys"),
    ).first()
    if size["keyed"] > size["keys"]:
        rest = [c for c in frame.columns if c not in keys]
        one = frame.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row")) if rest else frame.select(*keys).distinct()
        frame = one.select(*[c if c in keys else F.col(f"__row.{c}").alias(c) for c in frame.columns])
    return Dimension(frame, keys, size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes)


def lookup(
    facts: DataFrame,
    dim: Dimension,
    fact_keys: str | list[str] | None = None,
    how: str = "left",
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Append the attributes of `dim` to `facts`; `how` is `left` or `inner`.

    `fact_keys` names the key columns on the fact side where they differ from the dimension's.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported lookup: {how}")
    keys = dim.on if fact_keys is None else ((fact_keys,) if isinstance(fact_keys, str) else tuple(fact_keys))
    names = [f"__key_{i}" for i in range(len(keys))]
    side = dim.frame.select(*[F.col(k).alias(n) for k, n in zip(dim.on, names)], *dim.attributes)
    if dim.small:
        return _join(facts, F.broadcast(side), keys, names, how)
    if facts.isStreaming:
        # One micro-batch is bounded by the source's rate limit; the frequency count below is not
        # available on an unbounded input. Run the lookup inside foreachBatch to get the split.
        return _join(facts, side, keys, names, how)
    return _split_lookup(facts, side, keys, names, how, hot_keys)


def _join(facts: DataFrame, side: DataFrame, keys, names, how: str) -> DataFrame:
    condition = reduce(lambda a, b: a & b, [facts[k] == side[n] for k, n in zip(keys, names)])
    return facts.join(side, condition, how).drop(*names)


def _split_lookup(facts: DataFrame, side: DataFrame, keys, names, how: str, hot_keys: int) -> DataFrame:
    # Map-side combined count over the key columns only, then a bounded top-k: every key that is
    # not among the k most frequent holds at most 1/k of the rows.
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    top = (
        facts.where(present)
        .groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        .count()
        .orderBy(F.desc("count"), *names)
        .limit(hot_keys)
        .select(*names)
    )
    # At most `hot_keys` rows, fixed here so that both branches below use the same list.
    spark = facts.sparkSession
    hot = F.broadcast(spark.createDataFrame(top.collect(), top.schema))
    on_hot = reduce(lambda a, b: a & b, [facts[k] == hot[n] for k, n in zip(keys, names)])
    hot_side = side.join(hot, names, "left_semi")
    hot_rows = _join(facts.join(hot, on_hot, "left_semi"), F.broadcast(hot_side), keys, names, how)
    cold = facts.where(present).join(hot, on_hot, "left_anti")
    cold_rows = _join(cold, side, keys, names, how)
    result = hot_rows.unionByName(cold_rows)
    if how == "left":
        # Null keys match nothing: no join, no shuffle.
        empty = [F.lit(None).cast(side.schema[c].dataType).alias(c) for c in side.columns if c not in names]
        result = result.unionByName(facts.where(~present).select("*", *empty))
    return result
