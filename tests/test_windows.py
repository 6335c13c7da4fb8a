from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmart.operators import topn, windows

START = datetime(2024, 1, 1, 0, 0, 0)
EPOCH = datetime(1970, 1, 1)


def clicks_frame(spark, clicks):
    rows = [(START + timedelta(milliseconds=ms), func, user) for ms, func, user in clicks]
    return spark.createDataFrame(rows, "ts timestamp_ntz, func_id string, user_id string")


def hop_by_hand(clicks, size, slide):
    found = defaultdict(list)
    for ms, func, user in clicks:
        second = (START - EPOCH).total_seconds() + ms / 1000
        start = int(second // slide) * slide
        while start > second - size:
            found[start, func].append(user)
            start -= slide
    return {
        (EPOCH + timedelta(seconds=start), func): (len(users), len({u for u in users if u is not None}))
        for (start, func), users in found.items()
    }


click = st.tuples(
    st.integers(0, 400_000), st.sampled_from(["a", "b"]), st.sampled_from(["u1", "u2", "u3", None])
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(clicks=st.lists(click, min_size=1, max_size=60), shape=st.sampled_from([(70, 3), (60, 5), (60, 60), (90, 60)]))
def test_hopping_pv_uv_by_hand(spark, clicks, shape):
    size, slide = shape
    got = windows.hop_pv_uv(clicks_frame(spark, clicks), ["func_id"], size, slide).collect()
    assert {(r["window_start"], r["func_id"]): (r["pv"], r["uv"]) for r in got} == hop_by_hand(clicks, size, slide)
    counted = windows.hop_count(clicks_frame(spark, clicks), ["func_id"], size, slide).collect()
    assert {(r["window_start"], r["func_id"]): r["cnt"] for r in counted} == {
        key: pv for key, (pv, _) in hop_by_hand(clicks, size, slide).items()
    }
    assert all(r["window_end"] - r["window_start"] == timedelta(seconds=size) for r in got)


def test_hopping_windows_equal_those_of_the_window_function(spark):
    frame = clicks_frame(spark, [(0, "a", "u"), (2_999, "a", "u"), (71_000, "a", "v")])
    plain = frame.groupBy(F.window("ts", "70 seconds", "3 seconds").alias("w"), "func_id").agg(
        F.count("*").alias("pv"), F.count_distinct("user_id").alias("uv")
    )
    expected = {(r["w"]["start"], r["pv"], r["uv"]) for r in plain.collect()}
    got = windows.hop_pv_uv(frame, ["func_id"], 70, 3).collect()
    assert {(r["window_start"], r["pv"], r["uv"]) for r in got} == expected


def test_tumbling_report_takes_the_last_seen_attributes(spark):
    rows = [
        (START + timedelta(seconds=1), "d", 10, 1, "old"),
        (START + timedelta(seconds=9), "d", 5, 2, "tie"),
        (START + timedelta(seconds=9), "d", 5, 3, "new"),
        (START + timedelta(seconds=10), "d", 7, 4, "next"),
    ]
    frame = spark.createDataFrame(
        rows, "ts timestamp_ntz, dept_code string, amount bigint, intent_id bigint, fund_code string"
    )
    got = windows.tumble_report(frame, ["fund_code"]).orderBy("window_start").collect()
    assert [(r["lend_cnt"], r["lend_amount"], r["fund_code"]) for r in got] == [(3, 20, "new"), (1, 7, "next")]
    counts = windows.tumble_count(frame).orderBy("window_start").collect()
    assert [(r["event_time"], r["lend_cnt"]) for r in counts] == [("2024-01-01 00:00:09", 3), ("2024-01-01 00:00:10", 1)]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_top_n_ranks_from_one_and_breaks_ties_by_key(spark, n):
    counts = spark.createDataFrame(
        [("w1", "b", 2), ("w1", "a", 2), ("w1", "c", 9), ("w2", "z", 1)], "window_end string, func_id string, cnt bigint"
    )
    ranked = [("w1", "c", 1), ("w1", "a", 2), ("w1", "b", 3), ("w2", "z", 1)]
    got = topn.top_n(counts, n).orderBy("window_end", "rank").collect()
    assert [(r["window_end"], r["func_id"], r["rank"]) for r in got] == [r for r in ranked if r[2] <= n]


def test_top_n_is_limited_before_the_shuffle(spark):
    counts = spark.createDataFrame([("w", "a", 1)], "window_end string, func_id string, cnt bigint")
    plan = topn.top_n(counts, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ranking_text(spark):
    ranked = spark.createDataFrame(
        [(START, "b", 1, 2), (START, "a", 3, 1)], "window_end timestamp_ntz, func_id string, cnt bigint, rank int"
    )
    entry = lambda rank, func, cnt: f"{topn.RANK}{rank}{topn.FUNCTION}{func}{topn.VIEWS}{cnt}\n{topn.RULE}\n"
    head = f"{topn.HEAD}2024-01-01 00:00:00.0\n"
    assert topn.ranking_text(ranked).first()["report"] == head + entry(1, "a", 3) + entry(2, "b", 1)
