"""PV and exact UV of hopping windows over a stream, counted in each micro-batch as the batch operator counts them.

A chain of streamed aggregations can tell that a user is new to a window only by a state row per window, key and user: size / slide
times the data, written and removed one by one. Here a batch looks at each user's previous pane, and what lasts between
batches is a row per pane, key and user of the windows that are still open.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions import epoch_seconds
from eventmart.operators import windows
from eventmart.streaming.outputs import CommittedOutputs

BatchWriter = Callable[[DataFrame, int], None]


class HopReport:
    """A foreachBatch writer: page views and exact unique users per hopping window and key, each window once.

    The watermark is the greatest event time so far less `delay` seconds. A window fires in the batch that brings the watermark to its
    end, with all rows so far. A row whose pane the watermark of earlier batches has passed goes to the late side, as does one
    without a time; so every row is in exactly one of the two.

    Report, late rows and the panes of open windows are committed together. `report_to` and `late_to` are further writers; they
    get the committed rows, and get them again if the batch is repeated.
    """

    def __init__(
        self,
        path: str,
        keys: Sequence[str],
        size: int,
        slide: int,
        delay: int = 10,
        ts: str = "ts",
        user: str = "user_id",
        report_to: Sequence[BatchWriter] = (),
        late_to: Sequence[BatchWriter] = (),
    ):
        self.outputs = CommittedOutputs(path)
        self.keys, self.size, self.slide, self.delay, self.ts, self.user = list(keys), size, slide, delay, ts, user
        self.report_to, self.late_to = report_to, late_to

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.outputs.of_batch(spark, batch_id) is None:
            self._run(spark, batch, batch_id)
        done = self.outputs.of_batch(spark, batch_id)
        for name, writers in (("report", self.report_to), ("late", self.late_to)):
            for writer in writers:
                writer(self.outputs.read(spark, name, [done]).drop("version"), batch_id)

    def _run(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        before = self.outputs.last(spark)
        base = None if before is None else before.notes["seen"]
        seconds, pane = epoch_seconds(self.ts), gcd(self.size, self.slide)
        late = seconds.isNull()
        if base is not None:
            late = late | (seconds - F.pmod(seconds, F.lit(pane)) + pane <= base - self.delay)
        batch.persist()
        try:
            newest = batch.agg(F.max(seconds).alias("seen")).first()["seen"]
            seen = max((s for s in (base, newest) if s is not None), default=None)
            held = windows.user_panes(batch.where(~late), self.keys, self.size, self.slide, self.ts, self.user)
            if before is not None:
                kept = self.outputs.read(spark, "open", [before]).select(*held.columns)
                held = kept.unionByName(held).groupBy("__pane", *self.keys, self.user).agg(F.sum("__n").alias("__n"))
            held.persist()
            try:
                due = F.lit(False) if seen is None else F.col("__w") < self._first_open(seen)
                if base is not None:
                    due = due & (F.col("__w") >= self._first_open(base))
                fired = windows.user_windows(held, self.keys, self.size, self.slide, self.user, due)
                start = F.timestamp_seconds("__w").alias("window_start")
                end = F.timestamp_seconds(F.col("__w") + self.size).alias("window_end")
                # Older panes are in no open window.
                open_ = held if seen is None else held.where(F.col("__pane") >= self._first_open(seen))
                outputs = {"report": fired.select(start, end, *self.keys, "pv", "uv"), "late": batch.where(late), "open": open_}
                self.outputs.commit(spark, batch_id, outputs, lambda: {"seen": seen})
            finally:
                held.unpersist()
        finally:
            batch.unpersist()

    def _first_open(self, seen: int) -> int:
        """Start of the first window that ends after the watermark."""
        return ((seen - self.delay - self.size) // self.slide + 1) * self.slide

    # --- reading ---

    def results(self, spark: SparkSession) -> DataFrame | None:
        """All windows that have fired."""
        found = self.outputs.read(spark, "report")
        return None if found is None else found.drop("version")

    def late(self, spark: SparkSession) -> DataFrame | None:
        found = self.outputs.read(spark, "late")
        return None if found is None else found.drop("version")
