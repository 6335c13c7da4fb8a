"""Dimensions that are read anew while a stream runs, for use inside foreachBatch."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from eventmart.operators.lookup import Dimension, dimension
from eventmart.session import written
from eventmart.sources.dims import merge_snapshot, replace_snapshot
from eventmart.streaming.files import finished, remove
from eventmart.streaming.sinks import BatchWriter

log = logging.getLogger(__name__)


class RefreshedDimension:
    """The current snapshot for a batch.

    After `every` seconds the snapshot is loaded again and either replaces the one before or is
    merged into it (keys the new one lacks stay). Each accepted snapshot is written below `path`
    under the batch that took it, so merging does not grow a plan, and a restarted query goes on
    from the last one. An empty or failed load leaves the last snapshot in place.
    """

    def __init__(
        self,
        load: Callable[[SparkSession], DataFrame],
        on: str | Sequence[str],
        path: str,
        merge: bool = False,
        every: float = 60.0,
    ):
        self.load, self.path, self.merge, self.every = load, path, merge, every
        self.on = [on] if isinstance(on, str) else list(on)
        self._held: Dimension | None = None
        self._loaded_at = 0.0

    def __call__(self, spark: SparkSession, batch_id: int) -> Dimension:
        if self._held is None or time.monotonic() - self._loaded_at >= self.every:
            self._refresh(spark, batch_id)
        return self._held

    def _previous(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The newest snapshot of an earlier batch; of those before it, one is kept."""
        kept = sorted(n for n in finished(spark, self.path, "batch_id") if n < batch_id)
        for old in kept[:-2]:
            remove(spark, f"{self.path}/batch_id={old}")
        return spark.read.parquet(f"{self.path}/batch_id={kept[-1]}") if kept else None

    def _refresh(self, spark: SparkSession, batch_id: int) -> None:
        previous = self._previous(spark, batch_id)
        try:
            # Written first: the source is asked once, whether the snapshot is empty is asked of the copy.
            new = written(self.load(spark), "loaded")
            if previous is not None:
                new = merge_snapshot(previous, new, self.on) if self.merge else replace_snapshot(previous, new)
            target = f"{self.path}/batch_id={batch_id}"
            new.write.mode("overwrite").parquet(target)
            current = spark.read.schema(new.schema).parquet(target)
        except PySparkException:
            if previous is None:
                raise
            log.warning("dimension could not be loaded, the last snapshot stays", exc_info=True)
            current = previous
        self._held, self._loaded_at = dimension(current, self.on), time.monotonic()


def enrich_with(
    dim: RefreshedDimension, enrich: Callable[[DataFrame, Dimension], DataFrame], writer: BatchWriter
) -> BatchWriter:
    """Enrich each batch with the current snapshot, then hand it to the writer."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(enrich(batch, dim(batch.sparkSession, batch_id)), batch_id)

    return write
