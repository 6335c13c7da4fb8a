"""Late rows, alerts, totals, change records and upserts, against plain Python on small inputs."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmart.operators import alerts, cdc, late, merge, totals
from eventmart.plans import balance

START = datetime(2024, 1, 1, 0, 0, 0)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def at(seconds):
    return START + timedelta(seconds=seconds)


# --- late rows ---


def late_by_hand(seconds_in_arrival_order):
    seen, marks = None, []
    for second in seconds_in_arrival_order:
        end = (second // 10 + 1) * 10
        marks.append(seen is not None and end + 5 <= seen - 10)
        seen = second if seen is None else max(seen, second)
    return marks


def mark(spark, seconds):
    rows = [(i, at(s), i) for i, s in enumerate(seconds)]
    frame = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, arrival bigint")
    return [r["is_late"] for r in late.mark_late(frame).orderBy("event_id").collect()]


@SETTINGS
@given(st.lists(st.integers(0, 300_000), min_size=1, max_size=40))
def test_late_rows_by_hand(spark, seconds):
    assert mark(spark, seconds) == late_by_hand(seconds)


def test_late_by_four_six_and_twenty_seconds(spark):
    # Window 0..10 closes for good once 25 has been seen.
    assert mark(spark, [3, 24, 4]) == [False, False, False]
    assert mark(spark, [3, 25, 4]) == [False, False, True]
    assert mark(spark, [3, 45, 4, 31]) == [False, False, True, False]


def test_simultaneous_arrivals_are_ordered_by_id(spark):
    frame = spark.createDataFrame(
        [(1, at(0), 7), (2, at(100), 7), (3, at(1), 7)], "event_id bigint, ts timestamp_ntz, arrival bigint"
    )
    got = {r["event_id"]: r["is_late"] for r in late.mark_late(frame).collect()}
    assert got == {1: False, 2: False, 3: True}
    on_time, rest = late.route_late(late.mark_late(frame))
    assert on_time.count() == 2 and rest.count() == 1


# --- alerts ---


def alerts_by_hand(clicks, gap, ever=False):
    found = {}
    for ms, user, func in clicks:
        pairs = [m for m, u, f in clicks if u == user and f != func and m <= ms and (ever or ms - m <= gap * 1000)]
        since = None
        if ever:
            since = min((m for m, u, f in clicks if u == user and any(
                n <= m and v == user and g != f for n, v, g in clicks)), default=None)
        hit = (since is not None and ms >= since) if ever else bool(pairs)
        if hit:
            cell = (user, int(((START - datetime(1970, 1, 1)).total_seconds() * 1000 + ms) // (gap * 1000)))
            found[cell] = min(found.get(cell, ms), ms)
    return sorted((user, START + timedelta(milliseconds=ms)) for (user, _), ms in found.items())


click = st.tuples(st.integers(0, 6_000), st.sampled_from(["u", "v"]), st.sampled_from(["a", "b", "c"]))


@SETTINGS
@given(clicks=st.lists(click, min_size=1, max_size=25, unique=True), gap=st.sampled_from([1, 2]))
def test_alerts_by_hand(spark, clicks, gap):
    frame = spark.createDataFrame(
        [(START + timedelta(milliseconds=ms), u, f) for ms, u, f in clicks],
        "ts timestamp_ntz, user_id string, func_id string",
    )
    got = sorted((r["user_id"], r["alert_ts"]) for r in alerts.misuse_alerts(frame, gap).collect())
    assert got == alerts_by_hand(clicks, gap)
    got = sorted((r["user_id"], r["alert_ts"]) for r in alerts.misuse_alerts_ever(frame, gap).collect())
    assert got == alerts_by_hand(clicks, gap, ever=True)


def test_half_a_second_apart(spark):
    frame = spark.createDataFrame(
        [
            (at(0.8), "same", "a"),
            (at(1.3), "same", "a"),
            (at(0.8), "other", "a"),
            (at(1.3), "other", "b"),
            (at(0.8), "slow", "a"),
            (at(1.9), "slow", "b"),
        ],
        "ts timestamp_ntz, user_id string, func_id string",
    )
    got = alerts.alert_text(alerts.misuse_alerts(frame, 1)).collect()
    assert [(r["alert_ts"], r["alert"]) for r in got] == [(at(1.3), f"{alerts.ALERT_HEAD}other{alerts.ALERT_TAIL}")]


# --- totals and change records ---


def test_running_totals_signs_and_unknown_operations(spark):
    frame = spark.createDataFrame(
        [
            ("d", "u1", "I", 100),
            ("d", "u1", "U", 50),
            ("d", "u2", "US", 30),
            ("d", "u3", "X", 999),
            ("d", "u4", None, 999),
        ],
        "dept_code string, user_id string, op_flag string, amount bigint",
    )
    got = totals.running_totals(frame, ["dept_code"]).first()
    assert (got["lend_cnt"], got["lend_amount"], got["user_cnt"]) == (1, 120, 2)
    assert frame.where(totals.unknown_operation()).count() == 2


def test_running_delta_subtracts_counted_old_amounts_only(spark):
    frame = spark.createDataFrame(
        [("d", "u", "I", 100, None, None), ("d", "u", "U", 80, 100, 5), ("d", "v", "U", 70, 60, 2), ("d", "w", "U", 10, None, 4)],
        "dept_code string, user_id string, op_flag string, amount bigint, old_amount bigint, old_state int",
    )
    got = totals.running_delta(frame, ["dept_code"]).first()
    assert (got["lend_cnt"], got["lend_amount"], got["user_cnt"]) == (4, 100 - 20 + 70 + 10, 3)


def cell(value):
    return '{"value":%s,"isupdate":false}' % value


def change(lid, amount, dept, before=""):
    body = ",".join(
        f'"{k}":{cell(v)}'
        for k, v in {
            "lid": lid, "strloandate": '"2019-10-30 10:00:00"', "nborrowmode": '"240"', "lamount": amount,
            "nstate": 5, "strdeptcode": f'"{dept}"', "lborrowerid": '"7"',
        }.items()
    )
    return '{"tableName":"loan_intent","opFlag":"U",' + body + before + "}"


def test_signed_pairs_move_an_amount_between_departments(spark):
    old = ',"beforeRecord":' + change(1, 90, "b").replace('"tableName":"loan_intent","opFlag":"U",', "")
    texts = spark.createDataFrame([(change(1, 100, "a", old),), (change(2, 5, "a"),)], "value string")
    pairs = cdc.signed_pair(cdc.parse_change(texts))
    got = sorted((r["intent_id"], r["image"], r["dept_code"], r["amount"]) for r in pairs.collect())
    assert got == [(1, "before", "b", -90), (1, "current", "a", 100), (2, "current", "a", 5)]
    net = {r["dept_code"]: (r["lend_cnt"], r["lend_amount"]) for r in totals.net_totals(pairs, ["dept_code"]).collect()}
    assert net == {"a": (2, 105), "b": (-1, -90)}


def test_before_image_without_a_department(spark):
    text = '{"lid":' + cell(1) + ',"beforeRecord":{"lamount":' + cell(3) + "}}"
    got = cdc.unwrap_before(cdc.parse_change(spark.createDataFrame([(text,), ('{"lid":null}',)], "value string"))).collect()
    assert [(r["has_before"], r["old_amount"], r["old_dept_code"]) for r in got] == [(True, 3, None), (False, None, None)]


def test_relevant_change(spark):
    frame = spark.createDataFrame(
        [
            (1, 1572393600000, "U", False, True, False),
            (2, 1572393600000, "U", False, False, False),
            (3, 1572393600000, "I", False, False, False),
            (4, 1572393600000 + 86_400_000, "I", True, True, True),
        ],
        "id int, event_ms bigint, op_flag string, state_changed boolean, amount_changed boolean, fund_code_changed boolean",
    )
    assert [r["id"] for r in frame.where(cdc.relevant_change("2019-10-30")).collect()] == [1, 3]


def test_approximate_distinct_users(spark):
    frame = spark.range(1000).select(F.lit("d").alias("dept_code"), (F.col("id") % 300).alias("user_id"))
    assert totals.distinct_users(frame).first()["user_cnt"] == 300
    assert abs(totals.distinct_users(frame, approximate=True).first()["user_cnt"] - 300) < 30


# --- upserts ---


def test_upsert_takes_the_last_write_per_key(spark):
    target = spark.createDataFrame([("a", 1, 9), ("b", 2, 9)], "k string, v int, o int")
    batch = spark.createDataFrame([("a", 5, 1), ("a", 7, 2), ("a", 6, 2), ("c", 3, 1)], "k string, v int, o int")
    got = sorted(tuple(r) for r in merge.upsert(target, batch, ["k"], "o").collect())
    assert got == [("a", 7, 2), ("b", 2, 9), ("c", 3, 1)]


def test_change_labels(spark):
    target = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    batch = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, v int")
    assert {r["k"]: r["change"] for r in merge.change_label(target, batch, ["k"]).collect()} == {
        "a": "same", "b": "same", "c": "insert"
    }
    moved = batch.withColumn("v", F.lit(4))
    assert {r["change"] for r in merge.change_label(target, moved, ["k"]).collect()} == {"update", "insert"}


def test_report_can_be_distributed(spark):
    from conftest import SMALL
    from eventmart.plans.catalog import REPORT_DAY, STAGED_FUNDS, balance_inputs

    inputs = balance_inputs(spark, SMALL)
    plain = balance.balance_report(inputs, REPORT_DAY, STAGED_FUNDS)
    spread = balance.balance_report(inputs, REPORT_DAY, STAGED_FUNDS, distribute_by=["strdate"])
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spread.collect()))


# --- jobs ---


def test_jobs_send_every_row_on_or_to_quarantine(spark):
    from eventmart.operators.lookup import dimension
    from eventmart.plans import jobs
    from eventmart.sources import dims

    raw = spark.createDataFrame([("a", "n,b,c,d,e"), ("short", "n,b")], "k string, v string")
    orgs = dimension(dims.org_dimension(raw), "org_code")
    undated = change(4, 1, "a").replace("2019-10-30 10:00:00", "30 October")
    texts = [change(1, 9, "a"), change(2, 9, "short"), change(3, 9, "gone"), undated, '{"lid":']
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    flat, bad = jobs.flatten_changes(frame, orgs)
    assert flat.count() == 1 and bad.count() == 4
    assert '"detpname":"n"' in flat.first()["value"] and '"eventtime":1572429600000' in flat.first()["value"]
    rows, bad = jobs.table_intents(frame, orgs)
    assert rows.count() == 3 and bad.count() == 2
    connected, bad = jobs.connect_changes(frame, orgs, "loan_intent")
    assert connected.count() == 3 and bad.count() == 2
    flat_texts = ['{"strdeptcode":"a"}', '{"strdeptcode":"a","beforeRecord":{"strdeptcode":"gone"}}', "x"]
    frame = spark.createDataFrame([(t,) for t in flat_texts], "value string")
    connected, bad = jobs.connect_intents(frame, orgs)
    assert connected.count() == 1 and bad.count() == 2
