"""Running totals added up as changes: over batches, restarts, breaks, null keys; and retractions that add up to the table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from eventmart.operators import totals
from eventmart.streaming.outputs import CommittedOutputs
from eventmart.streaming.running import RunningTotals, ordered_into, retract_into
from eventmart.streaming.upsert_table import UpsertTable

KIND = "day string, dept_code string, user_id string, op_flag string, amount long, event_ms long, fund_code string"


def made(folder):
    return RunningTotals(f"{folder}/r", totals.sign_of_operation(), totals.signed_amount(), attributes=["fund_code"])


def batches(n=6):
    rng, out, at = random.Random(3), [], 0
    for _ in range(n):
        rows = []
        for _ in range(rng.randint(0, 40)):
            at += 1
            day, dept, user = rng.choice(["d1", "d2", None]), rng.choice(["a", "b", None]), rng.choice(["u1", "u2", "u3", None])
            rows.append((day, dept, user, rng.choice(["I", "U", "US", "X", None]), rng.randint(1, 9), at, f"f{at}"))
        out.append(rows)
    return [*out, []]


def expected(rows):
    found = {}
    for day, dept, user, flag, amount, at, fund in rows:
        sign = {"I": 1, "U": 1, "US": -1}.get(flag)
        if sign is not None:
            mine = found.setdefault((day, dept), [0, 0, set(), (0, "")])
            mine[0] += sign
            mine[1] += sign * amount
            mine[2] |= {user} - {None}
            mine[3] = max(mine[3], (at, fund))
    return {key: (c, a, len(users), fund) for key, (c, a, users, (_, fund)) in found.items()}


def held(running, spark):
    return {(r.day, r.dept_code): (r.lend_cnt, r.lend_amount, r.user_cnt, r.fund_code) for r in running.read(spark).collect()}


def test_totals_over_batches(spark, folder):
    """Equal to all rows at once after every batch, however often one is repeated, and with a new holder each time."""
    rows = []
    for batch_id, batch in enumerate(batches()):
        frame = spark.createDataFrame(batch, KIND)
        rows += batch
        for _ in range(2):
            made(folder)(frame, batch_id)
        assert held(made(folder), spark) == expected(rows)


class Break(Exception):
    pass


@pytest.mark.parametrize("name", ["totals", "users"])
@pytest.mark.parametrize("after", [False, True])
def test_a_break_between_the_tables(spark, folder, monkeypatch, name, after):
    one, two = [b for b in batches() if len(b) > 5][:2]
    made(folder)(spark.createDataFrame(one, KIND), 0)
    call = UpsertTable.__call__

    def broken(self, batch, batch_id):
        mine = self.path.endswith(name)
        if mine and not after:
            raise Break
        call(self, batch, batch_id)
        if mine:
            raise Break

    monkeypatch.setattr(UpsertTable, "__call__", broken)
    with pytest.raises(Break):
        made(folder)(spark.createDataFrame(two, KIND), 1)
    monkeypatch.undo()
    made(folder)(spark.createDataFrame(two, KIND), 1)
    assert held(made(folder), spark) == expected(one + two)


def test_retractions_add_up(spark, folder):
    """New, changed, unchanged and null keys; a repeated batch adds nothing."""
    table = UpsertTable(f"{folder}/t", ("k",), "v", ("k",))
    out = CommittedOutputs(f"{folder}/changes")
    writer = retract_into(out, table)
    steps = [[("a", 1, 10), ("b", 2, 20)], [("a", 3, 5), ("b", 2, 20), (None, 1, 1)], [(None, 4, 2), ("c", 1, 7)], []]
    for batch_id, step in enumerate(steps):
        frame = spark.createDataFrame(step, "k string, v int, m int")
        for _ in range(2):
            writer(frame, batch_id)
        signed = out.read(spark, "changes").agg(F.sum(F.col("sign") * F.col("m")), F.sum("sign")).first()
        assert tuple(signed) == tuple(table.read(spark).agg(F.sum("m"), F.count(F.lit(1))).first())
    changes = sorted(((r.version, r.k or "", r.m, r.sign) for r in out.read(spark, "changes").collect()))
    assert [c[1:] for c in changes if c[0] == 1] == [("", 1, 1), ("a", 5, 1), ("a", 10, -1)]


def test_changes_in_any_order(spark, folder):
    """Reordered, repeated and replayed changes give the totals of the clean input."""
    rng = random.Random(7)
    changes = [(f"r{i % 9}" if i % 9 else None, i, rng.choice("ab"), rng.randint(1, 50)) for i in range(80)]
    table = UpsertTable(f"{folder}/t", ("record",), "version", ("record",))
    out = CommittedOutputs(f"{folder}/changes")
    writer = ordered_into(out, table, "version")
    seen = changes + rng.sample(changes, 40)
    rng.shuffle(seen)
    for batch_id in range(5):
        frame = spark.createDataFrame(seen[batch_id::5], "record string, version int, dept string, amount int")
        for _ in range(2):
            writer(frame, batch_id)
    last = {}
    for record, version, dept, amount in changes:
        last[record] = (dept, amount)
    want = {d: (sum(a for x, a in last.values() if x == d), sum(x == d for x, _ in last.values())) for d in "ab"}
    signed = out.read(spark, "changes").groupBy("dept").agg(F.sum(F.col("sign") * F.col("amount")).alias("a"), F.sum("sign").alias("n"))
    assert {r.dept: (r.a, r.n) for r in signed.collect()} == want
    assert {r.record: (r.dept, r.amount) for r in table.read(spark).collect()} == last
