"""Writers for foreachBatch. Each is idempotent per batch id, so a repeated batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventmart.operators import merge
from eventmart.streaming.upsert_table import UpsertTable

BatchWriter = Callable[[DataFrame, int], None]


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what the source holds now, then stop."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def start_every(writer: DataStreamWriter, checkpoint: str, interval: str = "5 seconds") -> StreamingQuery:
    """Run on, firing every `interval` of processing time with what has come in."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def json_stream_writer(
    texts: DataFrame, path: str | None = None, kafka: Mapping[str, str] | None = None, topic: str | None = None
) -> DataStreamWriter:
    """Value-only JSON texts to a Kafka topic or to text files."""
    texts = texts.select("value")
    if kafka is not None:
        return texts.writeStream.format("kafka").options(**kafka).option("topic", topic)
    return texts.writeStream.format("text").option("path", path)


def append_to(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Append each batch as its own partition folder; a repeated batch replaces its own folder only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def append_jdbc(options: Mapping[str, str], table: str) -> BatchWriter:
    """Plain inserts over JDBC. A batch repeated after a failure may insert rows twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()

    return write


def stage_jdbc(
    options: Mapping[str, str],
    staging: str,
    keys: Sequence[str],
    order: str,
    then: Callable[[int], None] | None = None,
) -> BatchWriter:
    """Last row per key into a staging table, emptied and filled with each batch; `then` runs the database's own merge."""

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = merge.last_per_key(batch, keys, order).withColumn("batch_id", F.lit(batch_id))
        # Truncated, not dropped: its indexes and grants stay.
        writer = latest.write.format("jdbc").options(**options).option("dbtable", staging).option("truncate", "true")
        writer.mode("overwrite").save()
        if then is not None:
            then(batch_id)

    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """One result to several sinks, computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def documents_to(path: str, renames: dict[str, str] | None = None) -> BatchWriter:
    """Search-index documents, one JSON text per line; an index client can take the writer's place."""

    def write(batch: DataFrame, batch_id: int) -> None:
        merge.documents(batch, renames).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def list_pushes_to(path: str, key: str, value: str, order: str) -> BatchWriter:
    return append_to(path, lambda batch: merge.list_pushes(batch, key, value, order))


def change_log_to(path: str, table: UpsertTable) -> BatchWriter:
    """Log every row with its change label against the table, then upsert the table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        old = table.read(batch.sparkSession, before=batch_id)
        target = batch.limit(0) if old is None else old.select(*batch.columns)
        append_to(path)(merge.change_label(target, batch, table.keys), batch_id)
        table(batch, batch_id)

    return write
