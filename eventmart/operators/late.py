"""Late rows of a tumbling window, decided on arrival order.

A row is late when, among the rows that arrived before it, some event time had already passed the
end of its window by the out-of-orderness bound plus the allowed lateness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import epoch_seconds
from eventmart.operators.lookup import dimension, lookup
from eventmart.session import written

CELLS_PER_BLOCK = 8_640


def mark_late(
    rows: DataFrame,
    seconds: int = 10,
    delay: int = 10,
    lateness: int = 5,
    ts: str = "ts",
    arrival: tuple[str, ...] = ("arrival", "event_id"),
) -> DataFrame:
    """Append `is_late`.

    A running maximum over all rows in arrival order would be one task. Instead note that only
    window-grid values of the maximum matter: for each grid step, find the first arrival whose
    event time reaches it. That is a plain grouped minimum, and a suffix minimum over the (few)
    steps extends it to steps no row hit exactly. Each row then compares its own arrival with the
    first arrival that closed its window.
    """
    position = F.struct(*arrival)
    closing = delay + lateness
    # Step k is reached by an event time of (k + 1) * seconds + delay + lateness, which closes window k.
    reaches = F.floor((epoch_seconds(ts) - closing) / seconds).cast("bigint") - 1
    own = F.floor(epoch_seconds(ts) / seconds).cast("bigint")
    reached = rows.groupBy(reaches.alias("step")).agg(F.min(position).alias("first"))
    # Steps some row asks for but none reached exactly take the minimum of the later steps.
    nothing = F.lit(None).cast(reached.schema["first"].dataType)
    asked = rows.select(own.alias("step")).distinct().select("step", nothing.alias("first"))
    steps = reached.unionByName(asked).groupBy("step").agg(F.min("first").alias("first"))
    closed = _suffix_minimum(steps).select(F.col("step").alias("__step"), F.col("first").alias("__closed"))
    # Written once, as it is measured and then joined; one row per step.
    closed = written(closed, "closed")
    joined = lookup(rows.withColumn("__step", own), dimension(closed, "__step"))
    late = F.coalesce(F.col("__closed") < position, F.lit(False))
    return joined.withColumn("is_late", late).drop("__step", "__closed")


def _suffix_minimum(steps: DataFrame) -> DataFrame:
    """Minimum of `first` over all steps from each one on, in blocks so that no window is unbounded."""
    blocked = steps.withColumn("block", F.floor(F.col("step") / CELLS_PER_BLOCK))
    blocks = blocked.groupBy("block").agg(F.min("first").alias("low"))
    # One row per block (a day of 10-second steps): a small, unpartitioned window.
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("block", F.min("low").over(later).alias("carry"))
    inside = Window.partitionBy("block").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    running = blocked.withColumn("run", F.min("first").over(inside))
    return running.join(carried, "block").select("step", F.least("run", "carry").alias("first"))


def route_late(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return marked.where(~F.col("is_late")).drop("is_late"), marked.where("is_late").drop("is_late")


def late_against(watermark_base: Column, seconds: int, delay: int, lateness: int, ts: str = "ts") -> Column:
    """Whether a row's window was closed once the given event time (epoch seconds) had been seen."""
    window_end = (F.floor(epoch_seconds(ts) / seconds) + 1) * seconds
    return F.coalesce(window_end + lateness <= watermark_base - delay, F.lit(False))
