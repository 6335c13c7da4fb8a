"""Streams over several files give the batch results for closed windows, also after a restart."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from eventmart import fixtures, schemas, session
from eventmart.operators import alerts, enrich, late, merge, parse, topn, totals, windows
from eventmart.operators.lookup import dimension
from eventmart.plans.jobs import clean_clicks
from eventmart.session import shared_folder
from eventmart.sources import dims
from eventmart.sources.streams import kafka_options, read_json_stream, register_stream_table, with_event_time
from eventmart.streaming import aggregates, misuse, sinks
from eventmart.streaming.hops import HopReport
from eventmart.streaming.late import LateRouter
from eventmart.streaming.refresh import RefreshedDimension, enrich_with

START = datetime(2024, 1, 1)


def write_texts(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        file.write("\n".join(lines) + "\n")
    stamp = 1_700_000_000 + len(os.listdir(folder))
    os.utime(f"{folder}/{name}", (stamp, stamp))


def run(frame, mode, writer, folder):
    sinks.run_available(frame.writeStream.outputMode(mode).foreachBatch(writer), f"{folder}/checkpoint")


def rows(frame, columns=None):
    return sorted((tuple(r) for r in frame.select(*(columns or frame.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def click_files(spark, tmp_path_factory):
    """Clicks of the small data as JSON texts in four files in time order."""
    folder = str(tmp_path_factory.mktemp("clicks"))
    clicks = fixtures.view(spark, SMALL, "clicks").orderBy("ts").collect()
    lines = [
        json.dumps(
            {
                "appId": r["app_id"],
                "funcId": r["func_id"],
                "userId": r["user_id"],
                "orgCode": r["org_code"],
                "logoptime": r["ts"].strftime("%Y-%m-%dT%H:%M:%S.") + "%03dZ" % (r["ts"].microsecond // 1000),
            }
        )
        for r in clicks
    ]
    part = -(-len(lines) // 4)
    for i in range(4):
        write_texts(folder, f"part-{i}.txt", lines[i * part : (i + 1) * part])
    return folder


def click_stream(spark, folder, delay="10 seconds"):
    texts = read_json_stream(spark, path=folder, max_files=1)
    table = register_stream_table(texts, "clicks_stream", schemas.CLEAN_CLICK, "logoptime", delay)
    return table.select(
        F.col("appId").alias("app_id"),
        F.col("funcId").alias("func_id"),
        F.col("userId").alias("user_id"),
        F.col("orgCode").alias("org_code"),
        F.col("rowtime").alias("ts"),
    )


@pytest.fixture(scope="module")
def click_batch(spark, click_files):
    """The same clicks as a batch, with zoned times as the stream has them."""
    parsed = parse.parse_json(spark.read.text(click_files), schemas.CLEAN_CLICK)
    return parsed.select(
        F.col("appId").alias("app_id"),
        F.col("funcId").alias("func_id"),
        F.col("userId").alias("user_id"),
        F.col("orgCode").alias("org_code"),
        F.to_timestamp("logoptime").alias("ts"),
    )


def closed(batch, newest, delay, end="window_end"):
    return batch.where(F.col(end).cast("timestamp") <= F.lit(newest) - F.expr(f"interval {delay} seconds"))


def zoned(frame):
    return frame.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})


def test_hopping_pv_uv(spark, folder, click_files, click_batch):
    newest = click_batch.agg(F.max("ts")).first()[0]
    run(aggregates.hop_pv_uv(click_stream(spark, click_files), ["func_id"], 3600, 300), "append", sinks.append_to(f"{folder}/out"), folder)
    expected = closed(zoned(windows.hop_pv_uv(click_batch, ["func_id"], 3600, 300)), newest, 10)
    columns = ["window_start", "window_end", "func_id", "pv", "uv"]
    assert rows(spark.read.parquet(f"{folder}/out"), columns) == rows(expected, columns)


def test_top_n(spark, folder, click_files, click_batch):
    newest = click_batch.agg(F.max("ts")).first()[0]
    counts = aggregates.hop_count(click_stream(spark, click_files), ["func_id"], 600, 60)
    run(counts, "append", sinks.append_to(f"{folder}/out", lambda batch: topn.top_n(batch, 2)), folder)
    expected = closed(zoned(topn.hot_functions(click_batch, 2, 600, 60)), newest, 10)
    columns = ["window_end", "func_id", "cnt", "rank"]
    assert rows(spark.read.parquet(f"{folder}/out"), columns) == rows(expected, columns)


@pytest.mark.parametrize("ever", [False, True])
def test_misuse_alerts(spark, folder, click_files, click_batch, ever):
    newest = click_batch.agg(F.max("ts")).first()[0]
    gap = 3600
    found = misuse.misuse_alerts(click_stream(spark, click_files), gap, ever=ever)
    run(found, "append", sinks.append_to(f"{folder}/out"), folder)
    batch = (alerts.misuse_alerts_ever if ever else alerts.misuse_alerts)(click_batch, gap)
    cell_end = F.timestamp_seconds((F.floor(F.unix_seconds("alert_ts") / gap) + 1) * gap)
    expected = closed(batch.withColumn("end", cell_end), newest, 10, "end")
    assert rows(spark.read.parquet(f"{folder}/out"), ["user_id", "alert_ts"]) == rows(expected, ["user_id", "alert_ts"])


def test_running_totals_and_restart(spark, folder, click_files, click_batch):
    """Half of the files, then a new query from the same checkpoint with all of them."""

    def start(path):
        stream = click_stream(spark, path).withColumns({"op_flag": F.lit("I"), "amount": F.lit(3)})
        running = aggregates.running_totals(stream, totals.sign_of_operation(), totals.signed_amount(), dept="org_code")
        table = sinks.UpsertTable(f"{folder}/table", ("day", "org_code"), "lend_cnt", ("day",), load_time="optime")
        run(running, "update", table, folder)
        return table.read(spark)

    half = f"{folder}/in"
    for name in sorted(os.listdir(click_files))[:2]:
        with open(f"{click_files}/{name}") as file:
            write_texts(half, name, file.read().splitlines())
    before = start(half).agg(F.sum("lend_cnt")).first()[0]
    for name in sorted(os.listdir(click_files))[2:]:
        with open(f"{click_files}/{name}") as file:
            write_texts(half, name, file.read().splitlines())
    got = start(half)
    batch = click_batch.withColumns(
        {"op_flag": F.lit("I"), "amount": F.lit(3), "day": F.date_format("ts", "yyyy-MM-dd")}
    )
    expected = totals.running_totals(batch, ["day", "org_code"]).withColumn("org_code", F.col("org_code").cast("int"))
    assert before < click_batch.count()
    columns = [F.col("day").cast("string"), F.col("org_code").cast("int"), "lend_cnt", "lend_amount", "user_cnt"]
    assert rows(got, columns) == rows(expected, columns)
    assert got.where("optime is null").count() == 0


def test_late_update_within_the_allowed_lateness(spark, folder):
    """A row late by less than delay + lateness makes its window's complete result come again."""

    def line(second, amount):
        at = (START + timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
        return json.dumps({"dept_code": "d", "amount": amount, "at": at, "intent_id": amount})

    schema = schemas.struct(dept_code=schemas.STRING, amount=schemas.LONG, at=schemas.STRING, intent_id=schemas.LONG)
    for i, lines in enumerate([[line(3, 1), line(22, 2)], [line(4, 10)], [line(40, 3)], [line(41, 4)], [line(5, 100)]]):
        write_texts(f"{folder}/in", f"{i}.txt", lines)
    texts = read_json_stream(spark, path=f"{folder}/in", max_files=1)
    stream = with_event_time(parse.parse_json(texts, schema), F.to_timestamp("at"), "15 seconds")
    report = windows.tumble_report(stream, ["amount"]).drop("amount").withColumn("day", F.to_date("window_start"))
    table = sinks.UpsertTable(f"{folder}/table", ("day", "window_start", "dept_code"), "last_ts", ("day",))
    log = sinks.change_log_to(f"{folder}/log", table)
    run(report, "update", sinks.fan_out(log, sinks.documents_to(f"{folder}/docs")), folder)
    got = {r["window_start"].second: (r["lend_cnt"], r["lend_amount"]) for r in table.read(spark).collect()}
    # 4 s arrives while the watermark is at 7 s. 5 s arrives when it has been at 25 s for a batch
    # (a batch still takes what the batch before it would have taken), and is dropped.
    assert got == {0: (2, 11), 20: (1, 2), 40: (2, 7)}
    labels = [r["change"] for r in spark.read.parquet(f"{folder}/log").orderBy("batch_id", "window_start").collect()]
    assert labels == ["insert", "insert", "update", "insert", "update"]
    documents = [json.loads(r["value"]) for r in spark.read.text(f"{folder}/docs").collect()]
    assert len(documents) == 5 and all(isinstance(v, str) for d in documents for v in d.values())


def test_late_router(spark, folder):
    """Against arrival order by batches: the base is the newest event time of earlier batches."""
    seconds = [[3, 24], [4, 30], [5, 29, 12], [16, 18, 50], [21, 60]]
    for i, batch in enumerate(seconds):
        write_texts(f"{folder}/in", f"{i}.txt", [json.dumps({"s": s}) for s in batch])
    texts = read_json_stream(spark, path=f"{folder}/in", max_files=1)
    stream = parse.parse_json(texts, schemas.struct(s=schemas.LONG)).withColumn("ts", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("s")))
    router = LateRouter(f"{folder}/routed")
    run(stream, "append", router, folder)
    expected, seen = [], None
    for batch in seconds:
        expected += [s for s in batch if seen is not None and (s // 10 + 1) * 10 + 5 <= seen - 10]
        seen = max([*batch, *([seen] if seen is not None else [])])
    got = spark.read.parquet(f"{folder}/routed/late")
    assert sorted(r["s"] for r in got.collect()) == sorted(expected) == [5, 21]
    assert spark.read.parquet(f"{folder}/routed/on_time").count() == sum(map(len, seconds)) - len(expected)
    # Report and late side come from one decision: together they are the input.
    routed = LateRouter(f"{folder}/routed")
    on_time = spark.read.parquet(f"{folder}/routed/on_time")
    assert sorted(r["s"] for r in on_time.unionByName(got).collect()) == sorted(s for batch in seconds for s in batch)
    counts = on_time.groupBy(F.floor(F.col("s") / 10).alias("w")).count()
    report = windows.tumble_report(routed.on_time(spark).withColumns({"amount": F.lit(1), "dept": F.lit("d")}), [], dept="dept", tie="s")
    assert sorted(r["lend_cnt"] for r in report.collect()) == sorted(r["count"] for r in counts.collect())
    # A repeated batch replaces its own output.
    again = spark.createDataFrame([(5,), (29,), (12,)], "s bigint").withColumn(
        "ts", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("s"))
    ).withColumn(parse.CORRUPT, F.lit(None).cast("string"))
    router(again, 2)
    assert spark.read.parquet(f"{folder}/routed/late").count() == 2


def test_enrichment_stream_equals_batch(spark, folder):
    """Raw clicks to clean clicks: left and inner names, organisation names, JSON out."""
    clicks = fixtures.click_json(fixtures.view(spark, SMALL, "clicks"))
    functions = dimension(fixtures.view(spark, SMALL, "function_dim"), "func_id")
    users = dimension(fixtures.view(spark, SMALL, "user_dim"), "user_id")
    orgs = dimension(dims.org_dimension(fixtures.view(spark, SMALL, "org_raw")), "org_code")
    lines = [r["value"] for r in clicks.collect()]
    for i in range(3):
        write_texts(f"{folder}/in", f"{i}.txt", lines[i::3])
    for how in ("left", "inner"):
        stream, _ = clean_clicks(read_json_stream(spark, path=f"{folder}/in", max_files=1), functions, users, orgs, how=how)
        sinks.run_available(sinks.json_stream_writer(stream, f"{folder}/{how}"), f"{folder}/cp_{how}")
        assert rows(spark.read.text(f"{folder}/{how}")) == rows(clean_clicks(clicks, functions, users, orgs, how=how)[0])


def test_enrichment_with_a_large_dimension_on_a_stream(spark, folder):
    """Beyond the broadcast bound: a shuffled join per batch, or the split join inside foreachBatch."""
    from eventmart.operators.lookup import Dimension

    intents = fixtures.intent_rows(spark, SMALL).select("intent_id", "dept_code")
    lines = [json.dumps(r.asDict()) for r in intents.collect()]
    for i in range(2):
        write_texts(f"{folder}/in", f"{i}.txt", lines[i::2])
    schema = schemas.struct(intent_id=schemas.LONG, dept_code=schemas.STRING)
    small = dimension(dims.org_dimension(fixtures.view(spark, SMALL, "org_raw")), "org_code")
    large = Dimension(small.frame, small.on, False)
    expected = rows(enrich.org_default(intents, small))

    def stream():
        parsed = parse.parse_json(read_json_stream(spark, path=f"{folder}/in", max_files=1), schema)
        return parsed.drop(parse.CORRUPT)

    run(enrich.org_default(stream(), large), "append", sinks.append_to(f"{folder}/join"), f"{folder}/a")
    inside = sinks.append_to(f"{folder}/batch", lambda batch: enrich.org_default(batch, large))
    run(stream(), "append", inside, f"{folder}/b")
    columns = enrich.org_default(intents, small).columns
    assert rows(spark.read.parquet(f"{folder}/join"), columns) == expected
    assert rows(spark.read.parquet(f"{folder}/batch"), columns) == expected


def refreshed(spark, folder, snapshots, merge):
    """Names of codes 1 and 2 per batch, with one snapshot (or failure) per batch."""
    for i in range(len(snapshots)):
        write_texts(f"{folder}/in", f"{i}.txt", [json.dumps({"org_code": c}) for c in ("1", "2")])
    turn = iter(snapshots)

    def load(session):
        entries = next(turn)
        if entries is None:
            return session.read.parquet(f"{folder}/nowhere")
        return dims.org_dimension(session.createDataFrame(entries, "k string, v string"))

    dim = RefreshedDimension(load, "org_code", f"{folder}/snapshots", merge=merge, every=0)
    schema = schemas.struct(org_code=schemas.STRING)
    stream = parse.parse_json(read_json_stream(spark, path=f"{folder}/in", max_files=1), schema)
    run(stream, "append", enrich_with(dim, enrich.org_name, sinks.append_to(f"{folder}/out")), folder)
    out = spark.read.parquet(f"{folder}/out").groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.concat_ws("=", "org_code", "org_name"))).alias("names")
    )
    return [r["names"] for r in out.orderBy("batch_id").collect()]


SNAPSHOTS = [[("1", "a"), ("2", "a")], [], None, [("1", "b")]]


def test_replaced_dimension(spark, folder):
    got = refreshed(spark, folder, SNAPSHOTS, merge=False)
    assert got == [["1=a", "2=a"]] * 3 + [["1=b", "2="]]


def test_merged_dimension(spark, folder):
    got = refreshed(spark, folder, SNAPSHOTS, merge=True)
    assert got == [["1=a", "2=a"]] * 3 + [["1=b", "2=a"]]
    # A new holder, as after a restart, goes on from the written snapshots.
    later = RefreshedDimension(
        lambda session: dims.org_dimension(session.createDataFrame([("3", "c")], "k string, v string")),
        "org_code", f"{folder}/snapshots", merge=True,
    )
    assert sorted(r["org_code"] for r in later(spark, 9).frame.collect()) == ["1", "2", "3"]
    assert later(spark, 10) is later(spark, 11)


def test_strict_table_stops_the_stream(spark, folder):
    write_texts(f"{folder}/in", "0.txt", ['{"a":"x"}'])
    schema = schemas.struct(a=schemas.STRING, at=schemas.STRING)
    table = register_stream_table(read_json_stream(spark, path=f"{folder}/in"), "strict_table", schema, "at", strict=True)
    with pytest.raises(Exception, match="missing fields: at"):
        run(table, "append", sinks.append_to(f"{folder}/out"), folder)


def test_append_is_idempotent_and_pushes_are_rows(spark, folder):
    batch = spark.createDataFrame([("d", 3, START)], "dept string, n int, at timestamp")
    writer = sinks.list_pushes_to(f"{folder}/push", "dept", "n", "at")
    writer(batch, 0)
    writer(batch, 0)
    assert rows(spark.read.parquet(f"{folder}/push"), ["list_key", "list_value"]) == [("d", "3")]


def test_kafka_options_and_sources(spark):
    options = kafka_options("host:1", "topic", maxOffsetsPerTrigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "topic",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
    }
    with pytest.raises(ValueError):
        read_json_stream(spark)


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two
    if base is not None:
        assert one.startswith(f"{base.rstrip('/')}/x-")


def test_written_tables_also_go_to_a_temporary_folder(spark, folder, monkeypatch):
    """Without a shared folder in the session, a folder that exists already is used."""
    monkeypatch.setattr(session, "shared_folder", lambda spark, name: folder)
    frame = spark.range(3)
    assert session.written(frame, "x").count() == 3


def test_late_marks_equal_the_router_with_one_row_per_batch(spark):
    frame = spark.createDataFrame([(i, START + timedelta(seconds=s), i) for i, s in enumerate([3, 25, 4, 60, 33])], "event_id bigint, ts timestamp, arrival bigint")
    assert [r["is_late"] for r in late.mark_late(frame).orderBy("event_id").collect()] == [False, False, True, False, True]


def test_documents_rename(spark):
    frame = spark.createDataFrame([(1, None, "x")], "a int, b int, c string")
    assert merge.documents(frame, {"a": "A"}).first()["document"] == '{"A":"1","c":"x"}'


def test_periodic_firing_emits_the_running_result(spark, folder):
    """Each firing gives the totals so far, and rows are counted once however often it fires."""
    schema = schemas.struct(at=schemas.STRING, dept_code=schemas.STRING, user_id=schemas.STRING)
    line = json.dumps({"at": "2024-01-01T00:00:01.000Z", "dept_code": "d", "user_id": "u"})
    write_texts(f"{folder}/in", "0.txt", [line])
    rows_in = parse.parse_json(read_json_stream(spark, path=f"{folder}/in", max_files=1), schema)
    stream = with_event_time(rows_in, F.to_timestamp("at")).withColumns({"op_flag": F.lit("I"), "amount": F.lit(2)})
    running = aggregates.running_totals(stream, totals.sign_of_operation(), totals.signed_amount())
    table = sinks.UpsertTable(f"{folder}/table", ("day", "dept_code"), "lend_cnt", ("day",))
    writer = running.writeStream.outputMode("update").foreachBatch(table)
    query = sinks.start_every(writer, f"{folder}/checkpoint", "1 second")
    try:
        query.processAllAvailable()
        first = table.read(spark).first()
        write_texts(f"{folder}/in", "1.txt", [line, line])
        query.processAllAvailable()
        second = table.read(spark).first()
    finally:
        query.stop()
    assert (first["lend_cnt"], first["lend_amount"], first["user_cnt"]) == (1, 2, 1)
    assert (second["lend_cnt"], second["lend_amount"], second["user_cnt"]) == (3, 6, 1)


@pytest.mark.parametrize("kind", ["windows", "top", "alerts", "late"])
def test_restart_from_the_checkpoint(spark, folder, click_files, click_batch, kind):
    """Half of the files, a stop, and a new query on the same checkpoint with the rest: as if it had run through."""

    def start(path):
        clicks = click_stream(spark, path)
        if kind == "windows":
            run(aggregates.hop_pv_uv(clicks, ["func_id"], 3600, 300), "append", sinks.append_to(f"{folder}/out"), folder)
        elif kind == "top":
            counts = aggregates.hop_count(clicks, ["func_id"], 600, 60)
            run(counts, "append", sinks.append_to(f"{folder}/out", lambda batch: topn.top_n(batch, 2)), folder)
        elif kind == "alerts":
            run(misuse.misuse_alerts(clicks, 3600), "append", sinks.append_to(f"{folder}/out"), folder)
        else:
            run(clicks, "append", LateRouter(f"{folder}/out", seconds=60), folder)

    names = sorted(os.listdir(click_files))
    for some in (names[:2], names[2:]):
        for name in some:
            with open(f"{click_files}/{name}") as file:
                write_texts(f"{folder}/in", name, file.read().splitlines())
        start(f"{folder}/in")
    newest = click_batch.agg(F.max("ts")).first()[0]
    if kind == "windows":
        columns, expected = ["window_start", "window_end", "func_id", "pv", "uv"], zoned(windows.hop_pv_uv(click_batch, ["func_id"], 3600, 300))
        expected = closed(expected, newest, 10)
    elif kind == "top":
        columns, expected = ["window_end", "func_id", "cnt", "rank"], closed(zoned(topn.hot_functions(click_batch, 2, 600, 60)), newest, 10)
    elif kind == "alerts":
        cell_end = F.timestamp_seconds((F.floor(F.unix_seconds("alert_ts") / 3600) + 1) * 3600)
        columns, expected = ["user_id", "alert_ts"], closed(alerts.misuse_alerts(click_batch, 3600).withColumn("end", cell_end), newest, 10, "end")
    else:
        columns, expected = ["user_id", "ts"], click_batch  # in order of time, so nothing is late
    out = f"{folder}/out/on_time" if kind == "late" else f"{folder}/out"
    assert rows(spark.read.parquet(out), columns) == rows(expected, columns)


def test_replayed_parts_of_several_files(spark, folder, monkeypatch):
    """Each part is one micro-batch, whatever its number of files; no file and no task holds a whole part."""
    monkeypatch.setattr(fixtures, "FILE_ROWS", 100)
    rows = spark.range(0, 1000, 1, 8).withColumn("part", F.when(F.col("id") == 7, 1).when(F.col("id") < 600, 0).otherwise(3))
    for kind, frame in (("parquet", rows), ("text", rows.select("part", F.col("id").cast("string").alias("value")))):
        stream = fixtures.replayed(frame, F.col("part"), 4, f"{folder}/{kind}/in")
        run(stream, "append", sinks.append_to(f"{folder}/{kind}/out"), f"{folder}/{kind}")
        found = {row[0]: row[1] for row in spark.read.parquet(f"{folder}/{kind}/out").groupBy("batch_id").count().collect()}
        assert found == {0: 599, 1: 1, 3: 400}
        written = spark.read.format(kind).load(f"{folder}/{kind}/in/000").groupBy(F.input_file_name()).count()
        assert written.count() > 1 and written.agg(F.max("count")).first()[0] <= 200


def test_hop_report_equals_the_batch_and_restarts(spark, folder, click_files, click_batch):
    """Each closed window once, with the batch operator's counts; between batches a row per pane, key and user of open windows."""
    names = sorted(os.listdir(click_files))
    report = HopReport(f"{folder}/out", ["func_id"], 3600, 300)
    for some in (names[:2], names[2:]):
        for name in some:
            with open(f"{click_files}/{name}") as file:
                write_texts(f"{folder}/in", name, file.read().splitlines())
        run(click_stream(spark, f"{folder}/in"), "append", report, folder)
    newest = click_batch.agg(F.max("ts")).first()[0]
    columns = ["window_start", "window_end", "func_id", "pv", "uv"]
    expected = closed(zoned(windows.hop_pv_uv(click_batch, ["func_id"], 3600, 300)), newest, 10)
    assert rows(report.results(spark), columns) == rows(expected, columns)
    assert report.late(spark).count() == 0
    mark = int(newest.timestamp()) - 10
    first_open = (mark - 3600) // 300 * 300 + 300
    panes = windows.user_panes(click_batch, ["func_id"], 3600, 300).where(F.col("__pane") >= first_open)
    last = report.outputs.last(spark)
    assert rows(report.outputs.read(spark, "open", [last]).drop("version"), panes.columns) == rows(panes)


def test_hop_report_with_disorder_nulls_and_late_rows(spark, folder):
    """Rows out of order within the delay count; rows of passed panes and without time are handed over; a repeat changes nothing."""

    def batch(*found):
        made = [(k, u, None if s is None else START + timedelta(seconds=s)) for k, u, s in found]
        return spark.createDataFrame(made, "k string, u string, ts timestamp")

    seen = []
    report = HopReport(f"{folder}/out", ["k"], 60, 20, delay=10, user="u", report_to=[lambda found, n: seen.append((n, found.count()))])
    batches = [
        [("a", "x", 5), ("a", "x", 25), ("a", None, 26), (None, "y", 27), ("a", "x", 45)],
        [("a", "x", 31), ("a", "y", 36), ("a", "x", 19), ("a", "z", None), ("a", "x", 95)],
        [("a", "x", 79), ("a", "x", 84), (None, "y", 200)],
        [("a", "x", 10_000)],
        [],
    ]
    for i, found in enumerate(batches):
        report(batch(*found), i)
    report(batch(*batches[1]), 1)
    late = sorted((r["u"], r["ts"]) for r in report.late(spark).where("ts is not null").collect())
    # The watermark is at 35 s, then at 85 s: the panes that end at 20 s and at 80 s have been passed.
    assert late == [("x", START + timedelta(seconds=19)), ("x", START + timedelta(seconds=79))]
    assert report.late(spark).where("ts is null").count() == 1
    flat = [r for found in batches for r in found if r[2] not in (19, 79, None, 10_000)]
    expected = {}
    for k in ("a", None):
        for start in range(-40, 201, 20):
            users = [u for kk, u, s in flat if kk == k and start <= s < start + 60]
            if users:
                expected[(k, start)] = (len(users), len(set(users) - {None}))
    zero = START.timestamp() - datetime(1970, 1, 1).timestamp()
    got = [((r["k"], int(r["w"] - zero)), (r["pv"], r["uv"])) for r in report.results(spark).withColumn("w", F.unix_seconds("window_start")).collect()]
    assert len(got) == len(dict(got)) and dict(got) == expected
    assert [n for n, _ in seen] == [0, 1, 2, 3, 4, 1] and seen[-1][1] == seen[1][1]
