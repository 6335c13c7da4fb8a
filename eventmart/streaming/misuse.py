"""Account-misuse alerts on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ALERT = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("alert_us", T.LongType())])


def _alerts(rows: list[tuple[str, int]]) -> Iterator[pd.DataFrame]:
    if rows:
        yield pd.DataFrame(rows, columns=ALERT.names)


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list[tuple[int, int, str, int]]]]:
    """One user's rows (cell, lo, function, hi) by cell, in order."""
    rows = []
    for batch in batches:
        rows.extend(zip(*(batch[c].tolist() for c in ("cell", "lo", "func_id", "hi"))))
    rows.sort()
    for cell, group in groupby(rows, key=itemgetter(0)):
        yield cell, list(group)


class TwoFunctionsEver(StatefulProcessor):
    """The looser rule: from a user's second function on, ever, every cell with a click alerts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.functions = handle.getMapState("functions", "func_id string", "lo bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = {k[0] for k in self.functions.keys()}
        found = []
        for _, clicks in _cells(rows):
            alert = clicks[0][1] if len(known) > 1 else None
            for _, lo, func, _ in clicks:
                # Two functions decide; more need not be kept.
                if len(known) < 2 and func not in known:
                    known.add(func)
                    self.functions.updateValue((func,), (lo,))
                    if len(known) == 2:
                        alert = lo
            if alert is not None:
                found.append((key[0], alert))
        yield from _alerts(found)

    def close(self) -> None:
        pass


def _pairs_of_cells(cells: DataFrame, gap_seconds: int) -> DataFrame:
    """Alerts by a second aggregation: every cell with the one before it, as a window of two cells that moves by one.

    Such a window holds two entries per function at most, its first and last click in each cell; what alerts is picked from
    them by array functions, so no user's history is ever a list, and state is dropped with the watermark.
    """
    gap = gap_seconds * 1_000_000
    entry = F.struct("cell", "lo", F.col("func_id").alias("func"), "hi")
    both = cells.groupBy(F.window("w", f"{2 * gap_seconds} seconds", f"{gap_seconds} seconds").alias("pair"), "user_id")
    found = both.agg(F.collect_list(entry).alias("entries"))
    cell = F.floor(F.unix_micros("pair.start") / F.lit(gap)).cast("bigint") + 1
    found = found.select("user_id", "entries", cell.alias("cell"))
    clicks = F.expr("array_sort(transform(filter(entries, e -> e.cell = cell), e -> struct(e.lo as lo, e.func as func)))")
    found = found.select("user_id", "entries", "cell", clicks.alias("clicks")).where(F.size("clicks") > 0)
    # The last click on another function in the cell before, if the first click here is near enough to it; else the first click on
    # a second function, which one cell always holds within the gap.
    other = F.expr("array_max(transform(filter(entries, e -> e.cell < cell and e.func <> clicks[0].func), e -> e.hi))")
    found = found.select("user_id", "clicks", other.alias("other"))
    alert = F.when(F.col("clicks")[0]["lo"] - F.col("other") <= gap, F.col("clicks")[0]["lo"]).otherwise(F.expr("get(clicks, 1).lo"))
    return found.select("user_id", alert.alias("alert_us")).where("alert_us is not null")


def misuse_alerts(
    clicks: DataFrame, gap_seconds: int = 1, ever: bool = False, ts: str = "ts", user: str = "user_id", func: str = "func_id"
) -> DataFrame:
    """Alerts of a watermarked click stream; append mode.

    Clicks are first combined per (cell, user, function) by a built-in aggregation, before the shuffle too. Cells are then
    compared with the cell before by a second one. Only the looser rule (`ever`) needs a state of its own, and sees no more than
    the combined rows.
    """
    combined = clicks.groupBy(F.window(ts, f"{gap_seconds} seconds").alias("w"), user, func).agg(
        F.min(F.unix_micros(ts)).alias("lo"), F.max(F.unix_micros(ts)).alias("hi")
    )
    cells = combined.select(
        F.col(user).alias("user_id"),
        F.col(func).alias("func_id"),
        F.floor(F.unix_micros("w.start") / F.lit(gap_seconds * 1_000_000)).cast("bigint").alias("cell"),
        "lo",
        "hi",
        "w",
    )
    if not ever:
        alerts = _pairs_of_cells(cells, gap_seconds)
    else:
        alerts = cells.groupBy("user_id").transformWithStateInPandas(
            statefulProcessor=TwoFunctionsEver(), outputStructType=ALERT, outputMode="Append", timeMode="None"
        )
    return alerts.select("user_id", F.timestamp_micros("alert_us").alias("alert_ts"))
