"""Outputs of a batch that become visible together: prepared folders, then one commit record."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.streaming.files import commit_text, names, read_text, remove
from eventmart.streaming.upsert_table import STREAM, LostRace

GATHER = 50


@dataclass(frozen=True)
class Commit:
    """One batch of one owner: the folder of each of its outputs, and notes."""

    version: int
    owner: str
    batch_id: int
    folders: dict[str, str]
    notes: dict = field(default_factory=dict)


@dataclass(frozen=True)
class CommittedOutputs:
    """Named outputs below `path`, with one commit record per batch.

    A batch first writes each output into a folder of its own, where no reader looks. Then one file that only one writer
    can put there names them all. A break before that leaves nothing visible; the repeated batch writes new folders. A break
    after it leaves everything, and the repeated batch changes nothing. Owners are as in `UpsertTable`: a new checkpoint's batches follow
    the ones that are there. Every `gather` records, one takes in those before it, so that a reader opens few files.
    """

    path: str
    owner: str | None = None
    gather: int = GATHER

    def commits(self, spark: SparkSession) -> list[Commit]:
        """All batches so far, in order."""
        found: list[Commit] = []
        for version in reversed(self._versions(spark)):
            records = [Commit(*entry) for entry in json.loads(read_text(spark, f"{self.path}/commits/{version}.json"))]
            found = records + found
            if len(records) > 1 or version == 0:
                break
        return found

    def last(self, spark: SparkSession, before: int | None = None) -> Commit | None:
        """The newest batch, or the newest one that was there when batch `before` of this owner began."""
        owner, found = self.owner_of(spark), self.commits(spark)
        if before is not None:
            found = [c for c in found[: self._first_not_before(found, owner, before)]]
        return found[-1] if found else None

    @staticmethod
    def _first_not_before(found: Sequence[Commit], owner: str, before: int) -> int:
        return next((i for i, c in enumerate(found) if c.owner == owner and c.batch_id >= before), len(found))

    def of_batch(self, spark: SparkSession, batch_id: int) -> Commit | None:
        owner = self.owner_of(spark)
        return next((c for c in self.commits(spark) if (c.owner, c.batch_id) == (owner, batch_id)), None)

    def owner_of(self, spark: SparkSession) -> str:
        return self.owner or spark.sparkContext.getLocalProperty(STREAM) or ""

    def read(self, spark: SparkSession, name: str, commits: Sequence[Commit] | None = None) -> DataFrame | None:
        """All committed rows of an output, with the `version` they came in; None before the first batch."""
        found = self.commits(spark) if commits is None else commits
        paths = [f"{self.path}/{name}/{c.folders[name]}" for c in found if name in c.folders]
        if not paths:
            return None
        schema = T.StructType.fromJson(json.loads(found[-1].notes["schemas"][name]))
        return spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*paths)

    def commit(self, spark: SparkSession, batch_id: int, outputs: Mapping[str, DataFrame], notes: Callable[[], dict] | None = None) -> Commit:
        """Write and commit; a batch that its owner has committed already is left as it is. `notes` is asked once all is written."""
        done = self.of_batch(spark, batch_id)
        if done is not None:
            return done
        versions = self._versions(spark)
        version = versions[-1] + 1 if versions else 0
        folders, schemas = {}, {}
        for name, frame in outputs.items():
            folders[name] = f"version={version}/{uuid.uuid4().hex}"
            frame.write.parquet(f"{self.path}/{name}/{folders[name]}")
            schemas[name] = frame.schema.json()
        made = Commit(version, self.owner_of(spark), batch_id, folders, {**(notes() if notes else {}), "schemas": schemas})
        records = [*self.commits(spark), made] if version and version % self.gather == 0 else [made]
        text = json.dumps([[c.version, c.owner, c.batch_id, c.folders, c.notes] for c in records])
        if not commit_text(spark, f"{self.path}/commits/{version}.json", text):
            raise LostRace(f"version {version} of {self.path} is another writer's")
        if len(records) > 1:
            # Readers of an earlier list still find the records up to the gathering one before.
            for old in versions:
                if old < version - self.gather:
                    remove(spark, f"{self.path}/commits/{old}.json")
        return made

    def _versions(self, spark: SparkSession) -> list[int]:
        found = (name.partition(".") for name in names(spark, f"{self.path}/commits"))
        return sorted(int(number) for number, _, kind in found if kind == "json" and number.isdigit())


def atomic_fan_out(outputs: CommittedOutputs, **transforms: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer of one result to several named outputs, visible together."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if outputs.of_batch(spark, batch_id) is not None:
            return
        batch.persist()
        try:
            outputs.commit(spark, batch_id, {name: transform(batch) for name, transform in transforms.items()})
        finally:
            batch.unpersist()

    return write


def quarantine_split(
    outputs: CommittedOutputs, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]]
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer of texts to `good` and `bad` rows, with their counts in the commit's notes.

    The batch is read and parsed once: `split` must work on what is kept of it, so it gets the parsed batch. Counts are observed
    while the rows are written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if outputs.of_batch(spark, batch_id) is not None:
            return
        batch.persist()
        try:
            watched = {name: Observation() for name in ("good", "bad")}
            parts = dict(zip(watched, split(batch)))
            counted = {n: part.observe(watched[n], F.count(F.lit(1)).alias("n")) for n, part in parts.items()}
            outputs.commit(spark, batch_id, counted, lambda: {n: seen.get["n"] for n, seen in watched.items()})
        finally:
            batch.unpersist()

    return write


def split_counts(outputs: CommittedOutputs, spark: SparkSession) -> DataFrame:
    """Rows per batch of a splitter: batch, good, bad."""
    rows = [(c.version, c.notes["good"], c.notes["bad"]) for c in outputs.commits(spark)]
    return spark.createDataFrame(rows, "batch long, good long, bad long")
