"""A table with replace-into semantics that streams write into: runs of rows in levels, and one manifest per version."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators import merge
from eventmart.streaming.files import commit_text, names, read_text, remove

STREAM = "sql.streaming.queryId"
KEPT_VERSIONS = 20


@dataclass(frozen=True)
class Run:
    """A folder of rows, written once, with one row per key. `upto`: the last version whose rows it holds."""

    folder: str
    level: int
    upto: int


@dataclass(frozen=True)
class Manifest:
    """What the table is at one version: its runs from old to new, and each owner's last batch."""

    version: int
    owners: dict[str, int]
    schema: str
    runs: tuple[Run, ...]

    def to_json(self) -> str:
        runs = [[run.folder, run.level, run.upto] for run in self.runs]
        return json.dumps({"version": self.version, "owners": self.owners, "schema": self.schema, "runs": runs})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(found["version"], found["owners"], found["schema"], tuple(Run(*run) for run in found["runs"]))


class LostRace(RuntimeError):
    """Another writer made the next version first."""


@dataclass(frozen=True)
class UpsertTable:
    """A table with replace-into semantics, for `foreachBatch` or single calls.

    Each batch becomes a run of its last rows per key, in a folder of its own, and then a version: a manifest that names
    all runs in order. A version is made by one file that only one writer can put there. So a batch is in the table whole or
    not at all, wherever it broke off, and a reader keeps what its manifest names. Of each key the newest run's row counts; keys
    are compared null-safe.

    Versions are the table's own count. A manifest also holds each owner's last batch, an owner being a checkpoint (the id
    that a streaming query keeps in it) or the name given in `owner`. A batch that its owner has committed already changes
    nothing. A new checkpoint on a table that exists is a new owner: its batches follow the ones that are there, however low their
    numbers. Two writers at once: the slower one gets `LostRace` and changes nothing, its stream repeats the batch.

    When a level has `fanout` runs they are merged into one run of the next level, together with all levels that this fills,
    in one pass. A row is thus rewritten once per level at most: over n batches all merges together write at most
    log_fanout(n) times what the batches wrote, and a key range is only rewritten with the batches that touched it. Runs are sorted by
    `partition_by` and the keys, so that readers who filter by them skip row groups.
    """

    path: str
    keys: tuple[str, ...]
    order: str | tuple[str, ...]
    partition_by: tuple[str, ...]
    load_time: str | None = None
    fanout: int = 8
    owner: str | None = None

    def __post_init__(self):
        if not self.partition_by or set(self.partition_by) - set(self.keys):
            raise ValueError("partition columns must be key columns")
        if self.fanout < 2:
            raise ValueError("a level holds two runs at least")

    # --- reading ---

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The table, or None while no batch has been written. `before`: as it was when that batch of the owner began."""
        manifest = self.manifest(spark)
        if before is not None:
            owner = self._owner(spark)
            versions = iter(self._versions(spark)[1:])
            while manifest is not None and manifest.owners.get(owner, before - 1) >= before:
                earlier = next(versions, None)
                if earlier is None and manifest.version > 0:
                    raise ValueError(f"the table as it was before batch {before} is no longer kept")
                manifest = None if earlier is None else self._load(spark, earlier)
        return None if manifest is None else self._rows(spark, manifest)

    def manifest(self, spark: SparkSession) -> Manifest | None:
        versions = self._versions(spark)
        return self._load(spark, versions[0]) if versions else None

    def _versions(self, spark: SparkSession) -> list[int]:
        """Kept versions, newest first."""
        found = (name.partition(".") for name in names(spark, f"{self.path}/versions"))
        return sorted((int(number) for number, _, kind in found if kind == "json" and number.isdigit()), reverse=True)

    def _load(self, spark: SparkSession, version: int) -> Manifest:
        return Manifest.from_json(read_text(spark, f"{self.path}/versions/{version}.json"))

    def _rows(self, spark: SparkSession, manifest: Manifest) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest.schema))
        if len(manifest.runs) == 1:
            return spark.read.schema(schema).parquet(self._folder(manifest.runs[0]))
        return self._newest(spark, schema, manifest.runs)

    def _newest(self, spark: SparkSession, schema: T.StructType, runs: tuple[Run, ...]) -> DataFrame:
        parts = None
        for nth, run in enumerate(runs):
            rows = spark.read.schema(schema).parquet(self._folder(run)).withColumn("__nth", F.lit(nth))
            parts = rows if parts is None else parts.unionByName(rows)
        return merge.last_per_key(parts, self.keys, "__nth").drop("__nth")

    def _folder(self, run: Run) -> str:
        return f"{self.path}/runs/{run.folder}"

    # --- writing ---

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, owner = batch.sparkSession, self._owner(batch.sparkSession)
        before = self.manifest(spark)
        done = before.owners.get(owner) if before else None
        if done is not None and batch_id <= done:
            if batch_id < done and owner == "":
                raise ValueError(f"batch {batch_id} is older than the last one, {done}")
            return
        if self.load_time:
            batch = batch.withColumn(self.load_time, F.current_timestamp())
        order = [self.order] if isinstance(self.order, str) else list(self.order)
        # The batch is evaluated here, and nowhere else.
        latest = merge.last_per_key(batch, self.keys, order)
        schema = _nullable(latest.schema)
        if before is not None and json.loads(before.schema) != schema.jsonValue():
            raise ValueError(f"the batch's columns are not the table's: {latest.schema.simpleString()}")
        version = before.version + 1 if before else 0
        run = self._write(latest, version, 0)
        owners = {**(before.owners if before else {}), owner: batch_id}
        runs = (before.runs if before else ()) + (run,)
        made = Manifest(version, owners, json.dumps(schema.jsonValue()), runs)
        self._commit(spark, made)
        self._merge_levels(spark, made)

    def _owner(self, spark: SparkSession) -> str:
        return self.owner or spark.sparkContext.getLocalProperty(STREAM) or ""

    def _write(self, rows: DataFrame, version: int, level: int) -> Run:
        run = Run(f"{version}-{level}-{uuid.uuid4().hex}", level, version)
        by = [*self.partition_by, *(k for k in self.keys if k not in self.partition_by)]
        rows.sortWithinPartitions(*by).write.parquet(self._folder(run))
        return run

    def _commit(self, spark: SparkSession, manifest: Manifest) -> None:
        if not commit_text(spark, f"{self.path}/versions/{manifest.version}.json", manifest.to_json()):
            raise LostRace(f"version {manifest.version} of {self.path} is another writer's")

    def _merge_levels(self, spark: SparkSession, manifest: Manifest) -> None:
        """Merge full levels, from the lowest on; the batch is safe in its version before."""
        runs, level = list(manifest.runs), 0
        # Runs are in order of age and levels fall with it, so those of the lowest levels are the last ones.
        taken = 0
        while sum(run.level == level for run in runs) + (taken > 0) >= self.fanout:
            taken = sum(run.level <= level for run in runs)
            level += 1
        if not taken:
            self._clean(spark, manifest)
            return
        old, young = runs[:-taken], tuple(runs[-taken:])
        schema = T.StructType.fromJson(json.loads(manifest.schema))
        version = manifest.version + 1
        merged = self._write(self._newest(spark, schema, young), version, level)
        made = replace(manifest, version=version, runs=(*old, merged))
        self._commit(spark, made)
        self._clean(spark, made)

    def _clean(self, spark: SparkSession, manifest: Manifest) -> None:
        """Forget versions beyond the kept ones, and runs that none of the kept names.

        A writer that is still at work names its run after a version to come, so runs of later versions stay.
        """
        versions = self._versions(spark)
        if len(versions) < 2 * KEPT_VERSIONS:
            return
        kept, gone = versions[:KEPT_VERSIONS], versions[KEPT_VERSIONS:]
        used = {run.folder for version in kept for run in self._load(spark, version).runs}
        for version in gone:
            remove(spark, f"{self.path}/versions/{version}.json")
        for folder in names(spark, f"{self.path}/runs"):
            if folder not in used and int(folder.split("-")[0]) <= kept[-1]:
                remove(spark, f"{self.path}/runs/{folder}")


def _nullable(schema: T.StructType) -> T.StructType:
    """As files give it back: every column may be null."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
