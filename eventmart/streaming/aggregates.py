"""Aggregates in the forms a stream allows. Results equal those of the batch operators.

Plain tumbling aggregates need no second form: `windows.tumble_count` and `windows.tumble_report`
run on both.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators.totals import unknown_operation


def _bounds(window: str = "w") -> list[Column]:
    return [F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end")]


def hop_count(rows: DataFrame, keys: Sequence[str], size: int, slide: int, ts: str = "ts") -> DataFrame:
    """Rows per hopping window and key, through panes; append mode."""
    pane = F.window(ts, f"{gcd(size, slide)} seconds").alias("pane")
    panes = rows.groupBy(pane, *keys).agg(F.count(F.lit(1)).alias("n"))
    spread = F.window("pane", f"{size} seconds", f"{slide} seconds").alias("w")
    return panes.groupBy(spread, *keys).agg(F.sum("n").alias("cnt")).select(*_bounds(), *keys, "cnt")


def hop_pv_uv(
    clicks: DataFrame, keys: Sequence[str], size: int, slide: int, ts: str = "ts", user: str = "user_id"
) -> DataFrame:
    """PV and exact UV per hopping window and key; append mode.

    Three chained aggregations: per pane and user, per window and user, per window. A user's rows in
    a window become one row before users are counted, and the watermark bounds all three states.
    The second holds size / slide rows per pane, key and user; `hops.HopReport` does without them.
    """
    pane = F.window(ts, f"{gcd(size, slide)} seconds").alias("pane")
    seen = clicks.groupBy(pane, *keys, user).agg(F.count(F.lit(1)).alias("n"))
    spread = F.window("pane", f"{size} seconds", f"{slide} seconds").alias("w")
    per_user = seen.groupBy(spread, *keys, user).agg(F.sum("n").alias("n"))
    return (
        per_user.groupBy("w", *keys)
        .agg(F.sum("n").alias("pv"), F.count(user).alias("uv"))
        .select(*_bounds(), *keys, "pv", "uv")
    )


def running_totals(
    rows: DataFrame,
    count: Column,
    amount: Column,
    known: Sequence[str] = ("I", "U", "US"),
    dept: str = "dept_code",
    user: str = "user_id",
    ts: str = "ts",
    period: str = "1 day",
) -> DataFrame:
    """Totals per period and department with exact distinct users; update mode, any trigger.

    A set of users per department would be one ever-growing state row. Instead first sights of a
    user are found by deduplication on (period, department, user), whose state is spread by user and
    dropped with the watermark, and are counted in the same sums as the measures.
    """
    steps = rows.where(~unknown_operation(known=known)).select(
        F.window(ts, period).alias("w"), dept, user, count.cast("bigint").alias("c"), amount.alias("a")
    )
    zero = F.lit(0).cast("bigint")
    measures = steps.select("w", dept, "c", "a", zero.alias("u"))
    first_sights = (
        steps.where(F.col(user).isNotNull())
        .select("w", dept, user)
        .dropDuplicates(["w", dept, user])
        .select("w", dept, zero.alias("c"), zero.alias("a"), F.lit(1).cast("bigint").alias("u"))
    )
    return (
        measures.unionByName(first_sights)
        .groupBy("w", dept)
        .agg(F.sum("c").alias("lend_cnt"), F.sum("a").alias("lend_amount"), F.sum("u").alias("user_cnt"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), dept, "lend_cnt", "lend_amount", "user_cnt")
    )
