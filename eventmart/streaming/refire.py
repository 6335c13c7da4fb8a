"""Reports of tumbling windows that fire, fire again for late rows, and hand over rows that come too late, in one operator.

Spark's own windows drop what comes after the watermark without a word. Here each micro-batch is split by one rule and
aggregated with what open windows hold; report, late rows and open windows are committed together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions import epoch_seconds
from eventmart.operators import merge
from eventmart.operators.late import late_against
from eventmart.streaming.outputs import CommittedOutputs

BatchWriter = Callable[[DataFrame, int], None]


class RefiringReport:
    """A foreachBatch writer: count, amount, latest time and last-seen attributes per window and department.

    The watermark is the greatest event time of earlier batches less `delay`. A window fires when a batch has brought the watermark
    to its end, with all rows so far, and once more with each batch that brings a row for it within `lateness` after that;
    each firing gives its complete result. Then the window is forgotten. A row whose window has been forgotten when its batch begins
    goes to the late side, as it is. So every row is in exactly one of the two, whichever batch it comes in.

    Between batches there is one row per open window and department, in the tables of the commit; no group is ever held in one
    task, as rows are combined before the shuffle. A batch is evaluated once. `report_to` and `late_to` are further writers, for tables and
    indexes; they get the committed rows, and get them again if the batch is repeated.
    """

    def __init__(
        self,
        path: str,
        attributes: Sequence[str] = (),
        seconds: int = 10,
        delay: int = 10,
        lateness: int = 5,
        ts: str = "ts",
        dept: str = "dept_code",
        amount: str = "amount",
        tie: str = "intent_id",
        report_to: Sequence[BatchWriter] = (),
        late_to: Sequence[BatchWriter] = (),
    ):
        self.outputs = CommittedOutputs(path)
        self.attributes, self.dept, self.amount, self.ts, self.tie = list(attributes), dept, amount, ts, tie
        self.seconds, self.delay, self.lateness = seconds, delay, lateness
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
        late = late_against(F.lit(base).cast("bigint"), self.seconds, self.delay, self.lateness, self.ts)
        # A row without a time has no window: it goes to the late side, so that nothing is lost.
        late = late | F.col(self.ts).isNull()
        batch.persist()
        try:
            newest = batch.agg(F.max(epoch_seconds(self.ts)).alias("seen")).first()["seen"]
            seen = max((s for s in (base, newest) if s is not None), default=None)
            held = self._combine(self.outputs.read(spark, "open", [before]) if before else None, self._partial(batch.where(~late)))
            held.persist()
            try:
                end = F.col("window_end").cast("timestamp").cast("long")
                mark = F.lit(seen).cast("bigint") - self.delay
                due = F.coalesce(end <= mark, F.lit(False))
                report = held.where(due & F.col("touched")).drop("touched")
                open_ = held.where(F.coalesce(end + self.lateness > mark, F.lit(True)))
                open_ = open_.withColumn("touched", F.col("touched") & ~due)
                # The last struct of a result is taken apart for the report.
                outputs = {"report": self._flat(report), "late": batch.where(late), "open": open_}
                self.outputs.commit(spark, batch_id, outputs, lambda: {"seen": seen})
            finally:
                held.unpersist()
        finally:
            batch.unpersist()

    def _partial(self, rows: DataFrame) -> DataFrame:
        last = F.max(F.struct(self.ts, self.tie, *self.attributes)).alias("last")
        found = rows.groupBy(F.window(self.ts, f"{self.seconds} seconds").alias("w"), self.dept).agg(
            F.count(F.lit(1)).alias("lend_cnt"), F.sum(self.amount).alias("lend_amount"), last
        )
        ends = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
        return found.select(*ends, self.dept, "lend_cnt", "lend_amount", "last", F.lit(True).alias("touched"))

    def _combine(self, open_: DataFrame | None, fresh: DataFrame) -> DataFrame:
        """Results so far of open windows. `touched`: with rows that no firing has told of."""
        if open_ is None:
            return fresh
        sums = [F.sum(c).alias(c) for c in ("lend_cnt", "lend_amount")]
        rows = open_.select(*fresh.columns).unionByName(fresh)
        return rows.groupBy("window_start", "window_end", self.dept).agg(*sums, F.max("last").alias("last"), F.max("touched").alias("touched"))

    def _flat(self, held: DataFrame) -> DataFrame:
        parts = [F.col(f"last.{self.ts}").alias("last_ts"), *(F.col(f"last.{a}").alias(a) for a in self.attributes)]
        return held.select("window_start", "window_end", self.dept, "lend_cnt", "lend_amount", *parts)

    # --- reading ---

    def firings(self, spark: SparkSession) -> DataFrame | None:
        """Every firing, with the `version` of the batch it came in."""
        return self.outputs.read(spark, "report")

    def results(self, spark: SparkSession) -> DataFrame | None:
        """The last firing of each window and department."""
        found = self.firings(spark)
        keys = ["window_start", "window_end", self.dept]
        return None if found is None else merge.last_per_key(found, keys, "version").drop("version")

    def late(self, spark: SparkSession) -> DataFrame | None:
        found = self.outputs.read(spark, "late")
        return None if found is None else found.drop("version")

    def pending(self, spark: SparkSession) -> DataFrame | None:
        """Results so far of windows that have not fired."""
        last = self.outputs.last(spark)
        found = None if last is None else self.outputs.read(spark, "open", [last])
        return None if found is None else self._flat(found.where("touched"))
