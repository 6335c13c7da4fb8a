"""Streaming sources of JSON text, and event-time tables declared over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions import parse_iso
from eventmart.operators.parse import parse_json, parse_json_strict


def kafka_options(brokers: str, topic: str, start: str = "latest", **extra) -> dict[str, str]:
    """Options of the Kafka source.

    `start` counts for the first run only; later runs resume from the query's checkpoint.
    `maxOffsetsPerTrigger` among the extra options bounds a micro-batch.
    """
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": start,
        **{key: str(value) for key, value in extra.items()},
    }


def read_json_stream(
    spark: SparkSession,
    kafka: Mapping[str, str] | None = None,
    path: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A stream of JSON texts in `value`, from a Kafka topic or from text files of a folder."""
    if (kafka is None) == (path is None):
        raise ValueError("give either kafka options or a path")
    if kafka is not None:
        return spark.readStream.format("kafka").options(**kafka).load().select(F.col("value").cast("string"))
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def with_event_time(df: DataFrame, ts: str | Column = "ts", delay: str = "10 seconds", name: str = "ts") -> DataFrame:
    """Set the event-time column and how far events may be out of order.

    Watermarks need an instant, so a wall-clock time is read as UTC.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    return df.withColumn(name, ts.cast("timestamp")).withWatermark(name, delay)


def register_stream_table(
    texts: DataFrame,
    name: str,
    schema: T.StructType,
    rowtime_from: str,
    delay: str = "60 seconds",
    strict: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Declare JSON texts as the table `name`, with `rowtime` parsed from an ISO text member.

    Rows without a readable time are left out; `untimed` gives them. `strict` fails the query on an absent member.
    """
    parsed = (parse_json_strict if strict else parse_json)(texts, schema, keep=keep)
    rows = with_event_time(parsed, parse_iso(rowtime_from), delay, "rowtime").where("rowtime is not null")
    rows = rows.select(*keep, *[c for c in schema.names if c != rowtime_from], "rowtime")
    rows.createOrReplaceTempView(name)
    return rows


def untimed(texts: DataFrame, schema: T.StructType, rowtime_from: str, keep: Sequence[str] = ()) -> DataFrame:
    """The quarantine of a stream table: rows of unreadable text or time, with the text in `_corrupt_record` if that is it."""
    return parse_json(texts, schema, keep=keep).where(parse_iso(rowtime_from).isNull())
