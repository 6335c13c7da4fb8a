"""The upsert table: every key, every owner, breaks at every step, and what merging costs."""

from __future__ import annotations

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import parse
from eventmart.session import shared_folder
from eventmart.sources.streams import read_json_stream
from eventmart.streaming import sinks, upsert_table
from eventmart.streaming.files import commit_text, names, read_text
from eventmart.streaming.upsert_table import LostRace, UpsertTable

KIND = "slot string, k string, v int, o int"


def made(folder, **options):
    return UpsertTable(f"{folder}/t", ("slot", "k"), "o", ("slot",), **options)


def held(table, spark):
    return {(r.slot, r.k): r.v for r in table.read(spark).collect()}


def test_every_key_is_kept(spark, folder):
    """Null keys and null partitions included; a repeated batch changes nothing; levels take runs in."""
    table = made(folder, fanout=3)
    assert table.read(spark) is None
    first = spark.createDataFrame([("0", "a", 1, 1), ("1", "b", 2, 1), (None, "n", 3, 1), ("0", None, 4, 1)], KIND)
    table(first.limit(0), 0)
    assert table.read(spark).count() == 0
    table(first, 1)
    want = {("0", "a"): 1, ("1", "b"): 2, (None, "n"): 3, ("0", None): 4}
    for batch_id in range(2, 12):
        new = [("0", "a", batch_id, 1), ("0", "a", 0, 0), (None, f"n{batch_id % 4}", batch_id, 1), ("0", None, batch_id, 1)]
        frame = spark.createDataFrame(new, KIND)
        table(frame, batch_id)
        table(frame, batch_id)
        want |= {("0", "a"): batch_id, (None, f"n{batch_id % 4}"): batch_id, ("0", None): batch_id}
        assert held(table, spark) == want
        assert table.read(spark).count() == len(want)
        levels = [run.level for run in table.manifest(spark).runs]
        assert levels == sorted(levels, reverse=True) and all(levels.count(n) < 3 for n in levels)
    assert {r.v for r in table.read(spark, before=11).where("k = 'a'").collect()} == {10}
    with pytest.raises(ValueError):
        table(first, 0)
    with pytest.raises(ValueError):
        table(first.withColumn("more", F.lit(1)), 12)
    with pytest.raises(ValueError):
        UpsertTable("x", ("k",), "o", ("slot",))


def test_a_batch_is_evaluated_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(len(row))
            yield row

    table = made(folder, fanout=2)
    for batch_id in range(3):
        frame = spark.createDataFrame([("0", str(i), batch_id, 1) for i in range(100)], KIND)
        table(frame.mapInPandas(count, KIND), batch_id)
    assert seen.value == 300


def streamed(spark, folder, checkpoint, batches, table):
    """A stream of one batch a file, from its own input folder and checkpoint."""
    source = f"{folder}/{checkpoint}-in"
    os.makedirs(source, exist_ok=True)
    for n, rows in enumerate(batches, start=len(os.listdir(source))):
        with open(f"{source}/{n}.txt", "w") as file:
            file.writelines(json.dumps(dict(zip(("slot", "k", "v", "o"), row))) + "\n" for row in rows)
        os.utime(f"{source}/{n}.txt", (1_700_000_000 + n,) * 2)
    layout = schemas.struct(slot=schemas.STRING, k=schemas.STRING, v=schemas.LONG, o=schemas.LONG)
    rows = parse.parse_json(read_json_stream(spark, path=source, max_files=1), layout).drop(parse.CORRUPT)
    sinks.run_available(rows.writeStream.foreachBatch(table), f"{folder}/{checkpoint}")


def test_a_new_checkpoint_goes_on(spark, folder):
    """A second checkpoint starts at batch 0 again: nothing of the table is lost and its rows are the newer ones."""
    table = made(folder, fanout=2)
    streamed(spark, folder, "one", [[("0", "z", 0, 1)], [("0", "a", 1, 1)], [("0", "a", 2, 1)]], table)
    streamed(spark, folder, "two", [[("0", "a", 9, 1)]], table)
    assert held(table, spark) == {("0", "z"): 0, ("0", "a"): 9}
    streamed(spark, folder, "one", [[("0", "b", 5, 1)]], table)
    streamed(spark, folder, "two", [[("0", "b", 6, 1)], [("0", "c", 7, 1)]], table)
    assert held(table, spark) == {("0", "z"): 0, ("0", "a"): 9, ("0", "b"): 6, ("0", "c"): 7}
    assert sorted(table.manifest(spark).owners.values()) == [2, 3]


class Break(Exception):
    pass


@pytest.mark.parametrize("step", range(6))
def test_a_break_at_any_step(spark, folder, monkeypatch, step):
    """Stop at each writing of a run, at each commit and in between; the repeated batch makes it whole."""
    table = made(folder, fanout=2)
    table(spark.createDataFrame([("0", "a", 1, 1), ("0", "b", 1, 1)], KIND), 0)
    second, steps = spark.createDataFrame([("0", "a", 2, 1)], KIND), iter(range(100))
    write, commit = UpsertTable._write, upsert_table.commit_text

    def at(call):
        def run(*args):
            if next(steps) == step:
                raise Break
            out = call(*args)
            if next(steps) == step:
                raise Break
            return out

        return run

    monkeypatch.setattr(UpsertTable, "_write", at(write))
    monkeypatch.setattr(upsert_table, "commit_text", at(commit))
    with pytest.raises(Break):
        table(second, 1)
    monkeypatch.undo()
    # All of the batch, once its version is there, or nothing of it.
    assert held(table, spark) == {("0", "a"): 1 if step < 3 else 2, ("0", "b"): 1}
    table(second, 1)
    assert held(table, spark) == {("0", "a"): 2, ("0", "b"): 1}
    assert table.manifest(spark).owners == {"": 1}


def test_two_writers_at_once(spark, folder, monkeypatch):
    """The one that comes second to the version loses nothing of the other's and gets an error."""
    slow, quick = made(folder, owner="slow"), made(folder, owner="quick")
    write = UpsertTable._write

    def late(self, rows, version, level):
        run = write(self, rows, version, level)
        if self.owner == "slow":
            monkeypatch.undo()
            quick(spark.createDataFrame([("0", "q", 1, 1)], KIND), 0)
        return run

    monkeypatch.setattr(UpsertTable, "_write", late)
    batch = spark.createDataFrame([("0", "s", 1, 1)], KIND)
    with pytest.raises(LostRace):
        slow(batch, 0)
    assert held(quick, spark) == {("0", "q"): 1}
    slow(batch, 0)
    assert held(quick, spark) == {("0", "q"): 1, ("0", "s"): 1}


def test_commit_once(spark, folder):
    assert commit_text(spark, f"{folder}/x/1.json", "one") and not commit_text(spark, f"{folder}/x/1.json", "two")
    assert read_text(spark, f"{folder}/x/1.json") == "one"
    assert [name for name in names(spark, f"{folder}/x") if "json" in name and not name.endswith(".crc")] == ["1.json"]


def test_what_merging_writes(spark, monkeypatch):
    """Over 200 batches merges write no more than log_fanout(batches) times the batches; old versions go."""
    table, rows = made(shared_folder(spark, "amplification"), fanout=4), []
    written = {0: 0}

    # Only the bookkeeping is run: a run is as long as what goes into it.
    def write(self, frame, version, level):
        run = upsert_table.Run(f"{version}-{level}-x", level, version)
        size = 1 if level == 0 else sum(sizes[r.folder] for r in frame)
        sizes[run.folder] = size
        written[level] = written.get(level, 0) + size
        return run

    sizes = {}
    batch = spark.createDataFrame(rows, KIND)
    monkeypatch.setattr(UpsertTable, "_write", write)
    monkeypatch.setattr(UpsertTable, "_newest", lambda self, spark, schema, runs: runs)
    for batch_id in range(200):
        table(batch, batch_id)
    assert written[0] == 200
    assert sum(n for level, n in written.items() if level) <= 200 * math.log(200, 4)
    runs = table.manifest(spark).runs
    assert sum(sizes[run.folder] for run in runs) == 200 and len(runs) <= 3 * 5
    assert len(table._versions(spark)) < 2 * upsert_table.KEPT_VERSIONS
