"""Running totals of a stream from one pass, added up as changes, with distinct users and last-seen attributes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators import merge
from eventmart.operators.totals import unknown_operation
from eventmart.streaming.outputs import CommittedOutputs
from eventmart.streaming.upsert_table import UpsertTable

BatchWriter = Callable[[DataFrame, int], None]


class RunningTotals:
    """A foreachBatch writer: count, amount, distinct users and last-seen attributes per key, as of all rows so far.

    A batch's rows are combined per (key, user) first. Users whom no earlier batch has had for the key are first sights; they
    are the only thing kept about users, one row each in a table of its own, so no key's users are ever a set in one row. Sums, first sights
    and attributes are then added to the totals of the keys that the batch touches; nothing else is read or written but the days of
    the batch. The stream is read once and needs no state of its own.

    Both tables know which batch they have taken in. A batch that broke off between them is computed again from both as they were
    before it, and changes only what lacks it. The first of `keys` is the day; null keys are keys, null users are none.
    """

    def __init__(
        self,
        path: str,
        count: Column,
        amount: Column,
        known: Sequence[str] = ("I", "U", "US"),
        keys: Sequence[str] = ("day", "dept_code"),
        user: str = "user_id",
        attributes: Sequence[str] = (),
        order: Sequence[str] = ("event_ms", "user_id"),
    ):
        self.count, self.amount, self.known = count, amount, known
        self.keys, self.user, self.attributes, self.order = tuple(keys), user, list(attributes), list(order)
        day = (self.keys[0],)
        self.users = UpsertTable(f"{path}/users", (*self.keys, user), "__first", day)
        self.totals = UpsertTable(f"{path}/totals", self.keys, "lend_cnt", day)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, keys, user = batch.sparkSession, list(self.keys), self.user
        last = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)], *self.attributes)
        steps = (
            batch.where(~unknown_operation(known=self.known))
            .groupBy(*keys, *([user] if user not in keys else []))
            .agg(F.sum(self.count).cast("long").alias("c"), F.sum(self.amount).cast("long").alias("a"), F.max(last).alias("last"))
        )
        steps.persist()
        try:
            days = [row[0] for row in steps.select(keys[0]).distinct().collect()]  # days in one batch
            seen = self._of_days(self.users.read(spark, before=batch_id), days)
            here = steps.where(F.col(user).isNotNull()).select(*keys, user)
            fresh = (here if seen is None else merge.absent(here, seen, [*keys, user])).withColumn("__first", F.lit(batch_id).cast("long"))
            fresh.persist()
            try:
                zero, one = (F.lit(n).cast("long") for n in (0, 1))
                none = F.lit(None).cast(steps.schema["last"].dataType)
                sums = [(F.col("c"), F.col("a"), zero, F.col("last"), steps), (zero, zero, one, none, fresh)]
                names = ("lend_cnt", "lend_amount", "user_cnt", "last")
                added, sights = (rows.select(*keys, *(v.alias(n) for v, n in zip(values, names))) for *values, rows in sums)
                parts = added.unionByName(sights)
                old = self._of_days(self.totals.read(spark, before=batch_id), days)
                if old is not None:
                    parts = parts.unionByName(merge.present(old, steps.select(*keys).distinct(), keys))
                sums = [F.sum(c).alias(c) for c in ("lend_cnt", "lend_amount", "user_cnt")]
                self.totals(parts.groupBy(*keys).agg(*sums, F.max("last").alias("last")), batch_id)
                self.users(fresh, batch_id)
            finally:
                fresh.unpersist()
        finally:
            steps.unpersist()

    def _of_days(self, table: DataFrame | None, days: Sequence) -> DataFrame | None:
        if table is None:
            return None
        day = F.col(self.keys[0])
        wanted = day.isin([d for d in days if d is not None])
        return table.where(wanted | day.isNull() if None in days else wanted)

    def read(self, spark: SparkSession) -> DataFrame | None:
        found = self.totals.read(spark)
        if found is None:
            return None
        return found.select(*self.keys, "lend_cnt", "lend_amount", "user_cnt", *(F.col(f"last.{a}").alias(a) for a in self.attributes))


def retractions(table: UpsertTable, batch: DataFrame, batch_id: int) -> DataFrame:
    """What a batch of results changes, as rows with a `sign`: -1 for a row as the table had it, +1 for the new one.

    Unchanged rows give none. Summed with their signs over all batches, any measure gives its sum over the table.
    """
    new = merge.last_per_key(batch, table.keys, table.order)
    old = table.read(batch.sparkSession, before=batch_id)
    added = new.withColumn("sign", F.lit(1))
    if old is None:
        return added
    old = merge.present(old.select(*new.columns), new.select(*table.keys), table.keys).withColumn("sign", F.lit(-1))
    both = added.unionByName(old).groupBy(*new.columns).agg(F.sum("sign").cast("int").alias("sign"))
    return both.where("sign <> 0")


def retract_into(outputs: CommittedOutputs, table: UpsertTable) -> BatchWriter:
    """A foreachBatch writer: the batch's retractions as output `changes`, then the table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if outputs.of_batch(batch.sparkSession, batch_id) is None:
                outputs.commit(batch.sparkSession, batch_id, {"changes": retractions(table, batch, batch_id)})
            table(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def newer(table: UpsertTable, batch: DataFrame, batch_id: int, version: str) -> DataFrame:
    """Of each record the batch's greatest version, if it is greater than the table's: replayed and overtaken changes fall away."""
    keys = list(table.keys)
    latest = merge.last_per_key(batch, keys, version)
    old = table.read(batch.sparkSession, before=batch_id)
    if old is None:
        return latest
    known = merge.present(old.select(*keys, version), latest.select(*keys), keys)
    both = known.withColumn("__old", F.lit(True)).unionByName(latest.select(*keys, version).withColumn("__old", F.lit(False)))
    # A record is overtaken where its version in the table is as great at least.
    best = both.groupBy(*keys).agg(F.max(F.struct(version, "__old")).alias("best"))
    return merge.absent(latest, best.where("best.__old").select(*keys), keys)


def ordered_into(outputs: CommittedOutputs, table: UpsertTable, version: str) -> BatchWriter:
    """A foreachBatch writer of versioned changes in any order, with repeats: `table` keeps each record's last version, `changes` its
    retractions, so that their signed sums are those of the clean input.

    Repeats within the watermark may be dropped before (`dropDuplicatesWithinWatermark`); what comes later is dropped here.
    """
    into = retract_into(outputs, table)

    def write(batch: DataFrame, batch_id: int) -> None:
        into(newer(table, batch, batch_id, version), batch_id)

    return write
