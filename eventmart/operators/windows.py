"""Tumbling and hopping event-time windows.

Hopping aggregates go through panes: rows are first combined into slices of gcd(size, slide)
seconds, and only the combined slices are spread over the windows they belong to. Windows are
aligned to the epoch, as `window()` aligns them.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import epoch_seconds, seconds_to_ntz


def _bounds(length: Column | int) -> list[Column]:
    end = F.col("__w") + length
    return [seconds_to_ntz("__w").alias("window_start"), seconds_to_ntz(end).alias("window_end")]


def _aligned(seconds: Column, step: int) -> Column:
    return seconds - F.pmod(seconds, F.lit(step))


def tumble_count(intents: DataFrame, seconds: int = 10, ts: str = "ts", dept: str = "dept_code") -> DataFrame:
    """Per window and department: the latest event time as text, and the count."""
    counted = (
        intents.groupBy(F.window(ts, f"{seconds} seconds").alias("w"), dept)
        .agg(F.count(F.lit(1)).alias("lend_cnt"), F.max(ts).alias("last_ts"))
    )
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        dept,
        F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        "lend_cnt",
    )


def tumble_report(
    intents: DataFrame,
    attributes: Sequence[str],
    seconds: int = 10,
    ts: str = "ts",
    dept: str = "dept_code",
    amount: str = "amount",
    tie: str = "intent_id",
) -> DataFrame:
    """Per window and department: count, amount, latest event time and last-seen attributes.

    Arrival order does not exist in a distributed scan; last seen is the greatest (time, `tie`).
    """
    last = F.max(F.struct(ts, tie, *attributes)).alias("last")
    return (
        intents.groupBy(F.window(ts, f"{seconds} seconds").alias("w"), dept)
        .agg(F.count(F.lit(1)).alias("lend_cnt"), F.sum(amount).alias("lend_amount"), last)
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            dept,
            "lend_cnt",
            "lend_amount",
            F.col(f"last.{ts}").alias("last_ts"),
            *[F.col(f"last.{a}").alias(a) for a in attributes],
        )
    )


def hop_count(rows: DataFrame, keys: Sequence[str], size: int, slide: int, ts: str = "ts") -> DataFrame:
    """Rows per hopping window and key."""
    pane = _pane(size, slide)
    panes = rows.groupBy(_aligned(epoch_seconds(ts), pane).alias("__pane"), *keys).agg(
        F.count(F.lit(1)).alias("__n")
    )
    spread = panes.select(*keys, "__n", F.explode(_windows_of("__pane", size, slide, pane)).alias("__w"))
    return spread.groupBy("__w", *keys).agg(F.sum("__n").alias("cnt")).select(*_bounds(size), *keys, "cnt")


def _pane(size: int, slide: int) -> int:
    if not 0 < slide <= size:
        raise ValueError("the slide must be positive and not longer than the window")
    return gcd(size, slide)


def _windows_of(pane: str, size: int, slide: int, length: int, after: Column | None = None) -> Column:
    """Starts of the windows that hold the pane: multiples of `slide` in (pane + length - 1 - size, pane]."""
    first = _aligned(F.col(pane) + (length - 1) - size, slide) + slide
    return F.sequence(first, _aligned(F.col(pane), slide), F.lit(slide))


def hop_pv_uv(
    clicks: DataFrame,
    keys: Sequence[str],
    size: int,
    slide: int,
    ts: str = "ts",
    user: str = "user_id",
) -> DataFrame:
    """Page views and exact unique users per hopping window and key.

    A user is new to a window only through the user's first pane in it. With the user's previous
    pane at hand, a pane adds the user exactly to the windows starting after that pane. So unique
    users become a sum, and the (window, key, user) rows, size/slide times the data, never exist.
    """
    spread = user_windows(user_panes(clicks, keys, size, slide, ts, user), keys, size, slide, user)
    return spread.select(*_bounds(size), *keys, "pv", "uv")


def user_panes(
    clicks: DataFrame, keys: Sequence[str], size: int, slide: int, ts: str = "ts", user: str = "user_id"
) -> DataFrame:
    """Rows `__n` per pane (its start, `__pane`), key and user."""
    return clicks.groupBy(_aligned(epoch_seconds(ts), _pane(size, slide)).alias("__pane"), *keys, user).agg(
        F.count(F.lit(1)).alias("__n")
    )


def user_windows(
    seen: DataFrame, keys: Sequence[str], size: int, slide: int, user: str = "user_id", which: Column | None = None
) -> DataFrame:
    """PV and UV per window (its start, `__w`) and key, from rows of `user_panes`; `which` tells the windows wanted."""
    pane = _pane(size, slide)
    # One row per pane in each group, so a busy user's group is bounded by the time span.
    previous = F.lag("__pane").over(Window.partitionBy(*keys, user).orderBy("__pane"))
    oldest = F.col("__pane") + (pane - 1) - size
    new_from = F.greatest(F.coalesce(previous, oldest), oldest)
    parts = (
        seen.select("__pane", *keys, user, "__n", new_from.alias("__seen"))
        .groupBy("__pane", *keys, "__seen")
        .agg(F.sum("__n").alias("__pv"), F.count(user).alias("__uv"))
    )
    spread = parts.select(
        *keys, "__seen", "__pv", "__uv", F.explode(_windows_of("__pane", size, slide, pane)).alias("__w")
    )
    if which is not None:
        spread = spread.where(which)
    return spread.groupBy("__w", *keys).agg(
        F.sum("__pv").alias("pv"),
        F.sum(F.when(F.col("__w") > F.col("__seen"), F.col("__uv")).otherwise(0)).alias("uv"),
    )
