"""Side output for late rows: Spark drops them silently, so they are routed before the aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions import epoch_seconds
from eventmart.operators.late import late_against
from eventmart.streaming.files import finished, remove

KEPT_BASES = 100
_SEEN = T.StructType([T.StructField("seen", T.LongType())])


class LateRouter:
    """A foreachBatch writer that splits a batch into `on_time` and `late` folders below `path`.

    Lateness is measured against the greatest event time of all earlier batches. That one number is
    written per batch below `path`, so a repeated or resumed batch finds the same base; the last hundred are kept. A path
    without any (a new one under an old checkpoint) starts as a new stream does.

    A report that is to agree with the late side is made from `on_time`: one decision for both. The
    same rows aggregated under a watermark would be judged a second time, against another moment.
    """

    def __init__(self, path: str, seconds: int = 10, delay: int = 10, lateness: int = 5, ts: str = "ts"):
        self.path, self.seconds, self.delay, self.lateness, self.ts = path, seconds, delay, lateness, ts

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = sorted(n for n in finished(spark, f"{self.path}/seen", "batch_id") if n < batch_id)
        base = None
        if earlier:
            base = spark.read.schema(_SEEN).parquet(f"{self.path}/seen/batch_id={earlier[-1]}").first()["seen"]
        batch.persist()
        try:
            late = late_against(F.lit(base).cast("bigint"), self.seconds, self.delay, self.lateness, self.ts)
            batch.where(~late).write.mode("overwrite").parquet(f"{self.path}/on_time/batch_id={batch_id}")
            batch.where(late).write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}")
            newest = batch.agg(F.max(epoch_seconds(self.ts)).alias("seen"))
            newest = newest.select(F.greatest("seen", F.lit(base).cast("bigint")).alias("seen"))
            newest.write.mode("overwrite").parquet(f"{self.path}/seen/batch_id={batch_id}")
        finally:
            batch.unpersist()
        for old in earlier[:-KEPT_BASES]:
            remove(spark, f"{self.path}/seen/batch_id={old}")

    def on_time(self, spark: SparkSession) -> DataFrame:
        """All rows that were on time so far: what a report that agrees with the late side is made from."""
        return spark.read.parquet(f"{self.path}/on_time").drop("batch_id")
