"""Outputs that become visible together; late rows, firing and firing again; quarantine with counts."""

from __future__ import annotations

import json
import os
from collections import defaultdict
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import parse
from eventmart.sources.streams import read_json_stream
from eventmart.streaming import outputs as outputs_module
from eventmart.streaming import sinks
from eventmart.streaming.outputs import CommittedOutputs, atomic_fan_out, quarantine_split, split_counts
from eventmart.streaming.refire import RefiringReport
from eventmart.streaming.upsert_table import UpsertTable

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
LAYOUT = schemas.struct(s=schemas.LONG, dept_code=schemas.STRING, amount=schemas.LONG, intent_id=schemas.LONG, fund_code=schemas.STRING)


def write_lines(folder, n, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{n:03}.txt", "w") as file:
        file.writelines(line + "\n" for line in lines)
    os.utime(f"{folder}/{n:03}.txt", (1_700_000_000 + n,) * 2)


def run(frame, writer, folder, checkpoint="checkpoint"):
    sinks.run_available(frame.writeStream.foreachBatch(writer), f"{folder}/{checkpoint}")


BATCHES = [
    [(3, "a", 1), (24, "a", 2), (24, "b", 3)],
    [(4, "a", 10), (30, "b", 4), (36, "a", 1)],
    [(5, "a", 20), (29, "b", 5), (12, "a", 6), (50, "a", 1)],
    [(16, "a", 7), (18, "b", 8), (49, "b", 9), (60, "a", 2)],
    [(21, "a", 9), (None, "a", 5), (62, "b", 3), (95, "a", 1)],
    [(79, "a", 2), (44, "b", 1), (200, "a", 1)],
]


def expected(batches):
    """By hand: which firing each batch makes, and which rows are late."""
    seen, open_, fired, firings, late = None, defaultdict(list), {}, [], []
    for rows in batches:
        touched = set()
        for s, dept, amount in rows:
            if s is None or (seen is not None and (s // 10 + 1) * 10 + 5 <= seen - 10):
                late.append((s, dept, amount))
                continue
            key = (s // 10 * 10, dept)
            open_[key].append((s, amount))
            touched.add(key)
        seen = max([s for s, _, _ in rows if s is not None] + ([seen] if seen is not None else []))
        for key, held in sorted(open_.items()):
            if key[0] + 10 <= seen - 10 and (key not in fired or key in touched):
                fired[key] = (len(held), sum(a for _, a in held))
                firings.append((*key, *fired[key]))
    return firings, fired, late, {k: (len(v), sum(a for _, a in v)) for k, v in open_.items() if k not in fired}


def offset(moment):
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return int((moment - START).total_seconds())


def stream(spark, folder):
    rows = parse.parse_json(read_json_stream(spark, path=f"{folder}/in", max_files=1), LAYOUT).drop(parse.CORRUPT)
    return rows.withColumn("ts", F.timestamp_seconds(F.lit(int(START.timestamp())) + F.col("s")))


def feed(folder, batches, start=0):
    for n, rows in enumerate(batches, start=start):
        lines = [
            json.dumps({"s": s, "dept_code": d, "amount": a, "intent_id": 100 * n + i, "fund_code": f"f{a}"}) for i, (s, d, a) in enumerate(rows)
        ]
        write_lines(f"{folder}/in", n, lines)


@pytest.mark.parametrize("restart", [False, True])
def test_fire_late_and_fire_again(spark, folder, restart):
    table = UpsertTable(f"{folder}/table", ("window_start", "dept_code"), "last_ts", ("window_start",))
    late_rows = sinks.append_to(f"{folder}/late_table")
    report = lambda: RefiringReport(f"{folder}/report", ["fund_code"], report_to=[table], late_to=[late_rows])
    if restart:
        feed(folder, BATCHES[:3])
        run(stream(spark, folder), report(), folder)
        feed(folder, BATCHES[3:], start=3)
    else:
        feed(folder, BATCHES)
    last = report()
    run(stream(spark, folder), last, folder)
    firings, results, late, pending = expected(BATCHES)
    values = lambda frame: sorted((offset(r.window_start), r.dept_code, r.lend_cnt, r.lend_amount) for r in frame.collect())
    assert values(last.firings(spark)) == sorted(firings)
    assert len(firings) > len(results)
    want = sorted((*k, *v) for k, v in results.items())
    assert values(last.results(spark)) == want
    assert values(table.read(spark)) == want
    assert values(last.pending(spark)) == sorted((*k, *v) for k, v in pending.items())
    rows = [(r.s, r.dept_code, r.amount) for r in last.late(spark).collect()]
    assert sorted(rows, key=str) == sorted(late, key=str) and (None, "a", 5) in rows
    assert spark.read.parquet(f"{folder}/late_table").count() == len(late)
    # Nothing is lost and nothing counts twice.
    counted = sum(n for n, _ in results.values()) + sum(n for n, _ in pending.values())
    assert counted + len(late) == sum(map(len, BATCHES))
    by_window = {(offset(r.window_start), r.dept_code): r.fund_code for r in last.results(spark).collect()}
    assert by_window[0, "a"] == "f10"  # of the greatest time, 4 s; 5 s comes too late


class Break(Exception):
    pass


@pytest.mark.parametrize("step", range(4))
def test_both_outputs_or_none(spark, folder, monkeypatch, step):
    """A break before, between and after the outputs, and before the commit, leaves neither; the repeat leaves both once."""
    out = CommittedOutputs(f"{folder}/out")
    batch = spark.range(6)
    writer = atomic_fan_out(out, even=lambda rows: rows.where("id % 2 = 0"), texts=lambda rows: rows.select(F.col("id").cast("string").alias("t")))
    steps = iter(range(100))

    def counted(call):
        def go(*args, **named):
            if next(steps) == step:
                raise Break
            result = call(*args, **named)
            return result

        return go

    kind = type(batch.write)
    monkeypatch.setattr(kind, "parquet", counted(kind.parquet))
    monkeypatch.setattr(outputs_module, "commit_text", counted(outputs_module.commit_text))
    if step < 3:
        with pytest.raises(Break):
            writer(batch, 0)
        monkeypatch.undo()
        assert out.read(spark, "even") is None and out.read(spark, "texts") is None
    monkeypatch.undo()
    for _ in range(2):
        writer(batch, 0)
        assert sorted(r.id for r in out.read(spark, "even").collect()) == [0, 2, 4]
        assert out.read(spark, "texts").count() == 6


def test_commits_are_gathered(spark, folder):
    out = CommittedOutputs(f"{folder}/out", gather=4)
    for n in range(13):
        out.commit(spark, n, {"x": spark.range(n, n + 1)})
        assert [c.batch_id for c in out.commits(spark)] == list(range(n + 1))
    assert sorted(r.id for r in out.read(spark, "x").collect()) == list(range(13))
    assert len(out._versions(spark)) < 10
    assert out.last(spark, before=5).batch_id == 4


def test_quarantine_with_counts(spark, folder):
    """Good and bad rows of a stream add up to its input, from one parse, with counts by batch."""
    lines = [['{"s":1}', "{broken", '{"s":2}'], ["", '{"s":3}'], ['{"s":4}'] * 5]
    for n, some in enumerate(lines):
        write_lines(f"{folder}/in", n, some)
    parsed_rows = spark.sparkContext.accumulator(0)
    layout = schemas.struct(s=schemas.LONG)

    def seen(batches):
        for batch in batches:
            parsed_rows.add(len(batch))
            yield batch

    parsed = parse.parse_json(read_json_stream(spark, path=f"{folder}/in", max_files=1), layout)
    counted = parsed.mapInPandas(seen, parsed.schema)
    out = CommittedOutputs(f"{folder}/out")
    run(counted, quarantine_split(out, lambda rows: parse.split_valid(rows, F.lit(True))), folder)
    assert [tuple(r) for r in split_counts(out, spark).orderBy("batch").collect()] == [(0, 2, 1), (1, 1, 1), (2, 5, 0)]
    assert parsed_rows.value == sum(map(len, lines))
    assert out.read(spark, "good").count() == 8
    assert sorted(r[parse.CORRUPT] for r in out.read(spark, "bad").collect()) == ["", "{broken"]
