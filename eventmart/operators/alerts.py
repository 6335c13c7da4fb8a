"""Account misuse: one user on two different functions within a short gap.

Everything is decided on aggregates per (user, gap-long cell): the earliest and the latest click on
each function. A pair of clicks within the gap lies in one cell or in two neighbouring ones, so no
user's history is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cell(ts: str, gap_seconds: int) -> Column:
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    width = gap_seconds * 1_000_000
    return F.floor(micros / F.lit(width)).cast("bigint")


def misuse_alerts(
    clicks: DataFrame, gap_seconds: int = 1, ts: str = "ts", user: str = "user_id", func: str = "func_id"
) -> DataFrame:
    """At most one alert per user and gap-long cell: the first click in it that completes a pair.

    A click completes a pair when the user clicked another function at the same time or at most
    `gap_seconds` earlier.

    A cell needs its two earliest functions and the two latest ones of the cell before. So every
    combined row goes to its own cell as `now` and to the next cell as `before`, and one shuffle on
    (user, cell) brings both together, at most two rows per function.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    per_func = clicks.groupBy(user, _cell(ts, gap_seconds).alias("cell"), func).agg(
        F.min(micros).alias("lo"), F.max(micros).alias("hi")
    )
    roles = F.array(
        F.struct(F.col("cell").alias("cell"), F.lit(True).alias("now"), F.col("lo").alias("at")),
        F.struct((F.col("cell") + 1).alias("cell"), F.lit(False).alias("now"), F.col("hi").alias("at")),
    )
    placed = per_func.select(user, func, F.inline(roles)).repartition(user, "cell")
    nearest = F.when(F.col("now"), F.col("at")).otherwise(-F.col("at"))
    rank = F.row_number().over(Window.partitionBy(user, "cell", "now").orderBy(nearest, func))

    def pick(now: bool, place: int, column: str):
        wanted = (F.col("now") == now) & (F.col("rank") == place)
        return F.max(F.when(wanted, F.col(column)))

    edges = (
        placed.withColumn("rank", rank)
        .where("rank <= 2")
        .groupBy(user, "cell")
        .agg(
            pick(True, 1, "at").alias("first_at"),
            pick(True, 1, func).alias("first_func"),
            pick(True, 2, "at").alias("second_at"),
            pick(False, 1, "at").alias("last_at"),
            pick(False, 1, func).alias("last_func"),
            pick(False, 2, "at").alias("other_at"),
        )
    )
    # The latest click of the cell before on another function than this cell's first one.
    other = F.when(F.col("last_func") != F.col("first_func"), F.col("last_at")).otherwise(F.col("other_at"))
    near = F.col("first_at") - other <= gap_seconds * 1_000_000
    alert = F.when(near, F.col("first_at")).otherwise(F.col("second_at"))
    instant = F.timestamp_micros(alert).cast(clicks.schema[ts].dataType)
    return edges.select(user, instant.alias("alert_ts")).where(F.col("alert_ts").isNotNull())


def misuse_alerts_ever(
    clicks: DataFrame, gap_seconds: int = 1, ts: str = "ts", user: str = "user_id", func: str = "func_id"
) -> DataFrame:
    """The looser rule: once a user has used two functions, ever, every later click may alert.

    At most one alert per user and gap-long cell, at the first click not before the user's second
    function was first used.
    """
    firsts = clicks.groupBy(user, func).agg(F.min(ts).alias("lo"))
    order = Window.partitionBy(user).orderBy("lo", func)
    second = (
        firsts.withColumn("n", F.row_number().over(order)).where("n = 2").select(user, F.col("lo").alias("since"))
    )
    # Clicks are combined per cell before the join, so a busy user brings one row per cell. The cell
    # of `since` itself starts alerting at `since`, which is a click.
    cell = _cell(ts, gap_seconds)
    per_cell = clicks.groupBy(user, cell.alias("cell")).agg(F.min(ts).alias("lo"))
    alert = F.greatest("lo", "since")
    reached = per_cell.join(second, user).where(F.col("cell") >= _cell("since", gap_seconds))
    return reached.select(user, alert.alias("alert_ts"))


# The wording of an alert around the user.
ALERT_HEAD, ALERT_TAIL = "user_id --> ", " 被他人盗用"


def alert_text(alerts: DataFrame, user: str = "user_id") -> DataFrame:
    text = F.concat(F.lit(ALERT_HEAD), F.col(user), F.lit(ALERT_TAIL))
    return alerts.select(user, "alert_ts", text.alias("alert"))
