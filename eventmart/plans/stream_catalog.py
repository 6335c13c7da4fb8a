"""Streamed jobs as named queries: run over the tables as a stream until they are read, then read the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventmart import fixtures, schemas
from eventmart.functions import day_slot, epoch_to_text
from eventmart.operators import cdc, parse, topn, totals, windows
from eventmart.operators.enrich import OTHER_ORG
from eventmart.plans.catalog import _FULL, ALERT_GAP, ZONE, _filled, _functions, _orgs, _users, query, with_views
from eventmart.plans.jobs import REPORT_ATTRIBUTES, clean_clicks, connect_changes, connect_intents
from eventmart.session import shared_folder, state_partitions
from eventmart.sources.streams import register_stream_table, with_event_time
from eventmart.streaming import aggregates, misuse, sinks
from eventmart.streaming.hops import HopReport
from eventmart.streaming.outputs import CommittedOutputs, quarantine_split, split_counts
from eventmart.streaming.refire import RefiringReport
from eventmart.streaming.running import RunningTotals, ordered_into, retract_into


def _run(frame: DataFrame, mode: str, writer: sinks.BatchWriter, folder: str) -> None:
    with state_partitions(frame.sparkSession):
        sinks.run_available(frame.writeStream.outputMode(mode).foreachBatch(writer), f"{folder}/checkpoint")


def _wall_clock(frame: DataFrame) -> DataFrame:
    """Instants as the wall-clock times the batch queries give."""
    instants = [f.name for f in frame.schema if f.dataType.simpleString() == "timestamp"]
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})


def clean_stream(spark, sf, folder: str) -> DataStreamWriter:
    raw = fixtures.click_json(fixtures.stream_view(spark, sf, "clicks"))
    clean, _ = clean_clicks(raw, _functions(spark, sf), _users(spark, sf), _orgs(spark, sf), tz="UTC", how="inner")
    return sinks.json_stream_writer(clean, f"{folder}/clean").option("checkpointLocation", f"{folder}/clean_checkpoint")


_CLEAN = """clean as (select app_id, func_id, func_name, org_code, coalesce(dept_name, '') as org_name, user_id,
    user_name, event_id, date_trunc('second', ts) as ts from clicks join function_dim using (func_id)
    join user_dim using (user_id) left join org using (org_code) where event_id % 50 <> 0)"""


def _clean_sql(body: str) -> str:
    return with_views("clicks function_dim user_dim org", f", {_CLEAN} {body}")


@query(
    "stream_clean_json",
    sql=_clean_sql(
        """select '{"appId":"' || app_id || '","funcId":"' || func_id || '","funcName":"' || func_name || '"'
        || case when event_id % 51 = 0 then '' else ',"stropDate":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"' end
        || ',"orgCode":"' || org_code || '","orgName":"' || org_name || '","userId":"' || user_id
        || '","userName":"' || user_name || '"'
        || case when event_id % 51 = 0 then ''
            else ',"logoptime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z"' end || '}' as value from clean"""
    ),
)
def stream_clean_json(spark, sf):
    folder = shared_folder(spark, "clean")
    sinks.run_available(clean_stream(spark, sf, folder), f"{folder}/clean_checkpoint")
    return spark.read.text(f"{folder}/clean")


def _log_table(spark, sf) -> str:
    """The clean topic, in several micro-batches and with a closing record, declared as the streamed table `log_table`."""
    folder = shared_folder(spark, "table")
    sinks.run_available(clean_stream(spark, sf, folder), f"{folder}/clean_checkpoint")
    clean = spark.read.text(f"{folder}/clean")
    end = F.lit(f'{{"logoptime":"{fixtures.CLOSING.replace(" ", "T")}.000Z"}}').alias("value")
    read = clean.select("value", F.dayofmonth(F.get_json_object("value", "$.logoptime")).alias("day"))
    read = read.select("value", F.coalesce(F.floor((F.col("day") - 1) / 12), F.lit(0)).alias("part"))
    texts = fixtures.replayed(read.unionByName(spark.range(0, 1, 1, 1).select(end, F.lit(3).alias("part"))), F.col("part"), 4, f"{folder}/read")
    register_stream_table(texts, "log_table", schemas.CLEAN_CLICK, "logoptime")
    return folder


@query(
    "stream_select_all",
    sql=_clean_sql(
        """select app_id as "appId", func_id as "funcId", func_name as "funcName", strftime(ts, '%Y-%m-%d %H:%M:%S') as "stropDate",
        org_code as "orgCode", org_name as "orgName", user_id as "userId", user_name as "userName", ts as rowtime
        from clean where event_id % 51 <> 0"""
    ),
)
def stream_select_all(spark, sf):
    """All columns of the registered stream table, as they come."""
    folder = _log_table(spark, sf)
    _run(spark.sql("select * from log_table"), "append", sinks.append_to(f"{folder}/all"), folder)
    found = spark.read.parquet(f"{folder}/all").drop("batch_id")
    return _wall_clock(found.where(F.col("rowtime") < F.lit(fixtures.CLOSING).cast("timestamp")))


@query(
    "stream_table_pv_uv",
    sql=_clean_sql(
        """select make_timestamp(st * 1000000) as window_start, make_timestamp((st + 3600) * 1000000) as window_end,
        app_id as "appId", func_id as "funcId", func_name as "funcName", org_code as "orgCode", org_name as "orgName",
        strftime(ts, '%Y-%m-%d') as action_day, count(*) as pv, count(distinct user_id) as uv from (
            select *, cast(floor(epoch(ts) / 300) * 300 as bigint) - 300 * i as st
            from clean, range(12) t(i) where event_id % 51 <> 0) x
        where st <= epoch(ts) and epoch(ts) < st + 3600
        group by all"""
    ),
)
def stream_table_pv_uv(spark, sf):
    """The clean topic declared as a table with event time, and PV/UV of its 60-minute windows."""
    folder = _log_table(spark, sf)
    rows = spark.sql("select *, substring(stropDate, 1, 10) as action_day from log_table")
    keys = ["appId", "funcId", "funcName", "orgCode", "orgName", "action_day"]
    report = HopReport(f"{folder}/report", keys, 3600, 300, delay=60, ts="rowtime", user="userId")
    _run(rows, "append", report, folder)
    return _wall_clock(report.results(spark))


def _event_intents(spark, sf, delay: str) -> DataFrame:
    return with_event_time(fixtures.stream_view(spark, sf, "event_intents"), delay=delay)


@query(
    "stream_tumble_report",
    "event_intents",
    """select window_start, window_start + interval '10' second as window_end, dept_code, count(*) as lend_cnt,
        cast(sum(amount) as bigint) as lend_amount, max(ts) as last_ts,
        arg_max(fund_code, (ts, intent_id, fund_code)) as fund_code, strftime(window_start, '%Y-%m-%d') as day from (
            select *, make_timestamp(cast(floor(epoch(ts) / 10) * 10 as bigint) * 1000000) as window_start
            from event_intents) x group by window_start, dept_code""",
)
def stream_tumble_report(spark, sf):
    """Ten-second reports with five seconds of lateness, upserted into a table and sent as documents.

    The watermark delay holds both the out-of-orderness bound and the lateness; a late row makes the
    window's complete result come again, which replaces the earlier one.
    """
    folder = shared_folder(spark, "tumble")
    report = windows.tumble_report(_event_intents(spark, sf, "15 seconds"), ["fund_code"])
    report = report.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    target = sinks.UpsertTable(f"{folder}/report", ("day", "window_start", "dept_code"), "last_ts", ("day",))
    _run(report, "update", sinks.fan_out(target, sinks.documents_to(f"{folder}/documents")), folder)
    return _wall_clock(target.read(spark).withColumn("day", F.col("day").cast("string")))


# Arrival in six parts of five days, each row up to two days after its time; one-hour windows.
_PARTS = 6
_LATE = {"seconds": 3600, "delay": 7200, "lateness": 3600}
_ARRIVED = f"""arrived as (
        select e.*, o.*, cast(floor(epoch(ts)) as bigint) as s, make_timestamp(cast(floor(epoch(ts) / 3600) * 3600 as bigint) * 1000000) as window_start,
            cast(least({_PARTS - 1}, floor((epoch(ts) - 1704067200 + (intent_id * 7919) % 172800) / 432000)) as integer) as part
        from event_intents e join {_FULL} o on o.org_code = e.dept_code),
    seen as (select part, max(max(s)) over (order by part rows between unbounded preceding and 1 preceding) as base,
            max(max(s)) over () as newest from arrived group by part),
    judged as (select a.*, newest, coalesce((s // 3600 + 1) * 3600 + 3600 <= base - 7200, false) as is_late from arrived a join seen using (part))"""


def _late_report(spark, sf) -> RefiringReport:
    """Intents from text, as they arrive, to the report of all ten columns and its late side."""
    folder = shared_folder(spark, "late")
    rows = fixtures.view(spark, sf, "event_intents")
    delayed = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - 1_704_067_200 + (F.col("intent_id") * 7919) % 172_800) / 432_000)
    texts = fixtures.flat_intent_json(rows.withColumn("part", F.least(F.lit(_PARTS - 1), delayed).cast("int")), ("part",))
    raw = fixtures.replayed(texts, F.col("part"), _PARTS, f"{folder}/in")
    connected, _ = connect_intents(raw, _orgs(spark, sf))
    intents, _ = parse.split_valid(parse.parse_intent(connected), parse.valid_event_time())
    timed = intents.withColumn("ts", F.timestamp_millis("event_ms"))
    report = RefiringReport(f"{folder}/report", REPORT_ATTRIBUTES, tie="user_id", **_LATE)
    _run(timed, "append", report, folder)
    return report


@query(
    "stream_late_report",
    "event_intents org",
    f""", {_ARRIVED} select window_start, window_start + interval '1' hour as window_end, dept_code, count(*) as lend_cnt,
        cast(sum(amount) as bigint) as lend_amount, date_trunc('millisecond', max(ts)) as last_ts,
        {", ".join(f"max({c}) as {c}" for c in OTHER_ORG)}, arg_max(fund_code, (ts, user_id, fund_code)) as fund_code,
        (epoch(window_start) + 3600 <= max(newest) - 7200) as fired
        from judged where not is_late group by window_start, dept_code""",
)
def stream_late_report(spark, sf):
    """The last firing of every window, and what windows hold that have not fired."""
    report = _late_report(spark, sf)
    fired, pending = report.results(spark), report.pending(spark)
    return _wall_clock(fired.withColumn("fired", F.lit(True)).unionByName(pending.withColumn("fired", F.lit(False))))


@query(
    "stream_late_rows",
    "event_intents org",
    f""", {_ARRIVED} select dept_code, user_id, amount, date_trunc('millisecond', ts) as ts from judged where is_late""",
)
def stream_late_rows(spark, sf):
    """The late side of the same report."""
    return _wall_clock(_late_report(spark, sf).late(spark).select("dept_code", "user_id", "amount", "ts"))


@query(
    "stream_quarantine_counts",
    "clicks",
    """select cast(least(3, floor((epoch(ts) - 1704067200) / 691200)) as bigint) as batch,
        count(*) filter (where event_id % 50 <> 0) as good, count(*) filter (where event_id % 50 = 0) as bad from clicks group by 1""",
)
def stream_quarantine_counts(spark, sf):
    """Readable and unreadable clicks of each batch, written from one parse, and how many there were."""
    folder = shared_folder(spark, "quarantine")
    part = F.least(F.lit(3), F.floor((F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - 1_704_067_200) / 691_200)).alias("part")
    clicks = fixtures.view(spark, sf, "clicks").withColumn("part", part.cast("int"))
    texts = fixtures.replayed(fixtures.click_json(clicks, ("part",)), F.col("part"), 4, f"{folder}/in")
    split = CommittedOutputs(f"{folder}/split")
    parsed = parse.parse_json(texts, schemas.RAW_CLICK)
    _run(parsed, "append", quarantine_split(split, lambda rows: parse.split_valid(rows, F.lit(True))), folder)
    return split_counts(split, spark)


_OWN_ORG = ", ".join(f"max({c}) as {c}" for c in OTHER_ORG)


@query(
    "stream_running_totals",
    "event_intents org",
    f"""select strftime(ts, '%Y-%m-%d') as day, dept_code,
        cast(sum(case when op_flag in ('I', 'U') then 1 else -1 end) as bigint) as lend_cnt,
        cast(sum(case when op_flag in ('I', 'U') then amount else -amount end) as bigint) as lend_amount,
        count(distinct user_id) as user_cnt, {_OWN_ORG}, arg_max(fund_code, (epoch_ms(ts), user_id, fund_code)) as fund_code
        from event_intents join {_FULL} o on org_code = dept_code group by 1, 2""",
)
def stream_running_totals(spark, sf):
    """Intents from text in three micro-batches of any order to running totals with every attribute."""
    folder = shared_folder(spark, "totals")
    intents = fixtures.view(spark, sf, "event_intents").withColumn("part", F.col("intent_id") % 3)
    texts = fixtures.replayed(fixtures.flat_intent_json(intents, ("part",)), F.col("part"), 3, f"{folder}/in")
    connected, _ = connect_intents(texts, _orgs(spark, sf))
    rows, _ = parse.split_valid(parse.parse_intent(connected), parse.valid_event_time(allow_zero=True))
    rows = rows.where("state = 9").withColumn("day", epoch_to_text("event_ms", "yyyy-MM-dd"))
    running = RunningTotals(f"{folder}/totals", totals.sign_of_operation(), totals.signed_amount(), attributes=REPORT_ATTRIBUTES)
    _run(rows, "append", running, folder)
    return running.read(spark)


@query(
    "stream_running_delta",
    "rows_ org",
    f"""select coalesce(day, '1970-01-01') as day, dept_code, count(*) as lend_cnt,
        cast(sum(case when op_flag = 'I' then amount
            else amount - case when old_state in (4, 5, 7, 9) then old_amount else 0 end end) as bigint) as lend_amount,
        count(distinct user_id) as user_cnt, {", ".join(f"max(o.{c}) as {c}" for c in OTHER_ORG)},
        arg_max(fund_code, (coalesce(epoch_ms(ts), -1), intent_id)) as fund_code
        from rows_ join {_filled('o', 'dept_code')} o on o.k = dept_code
        where table_name = 'loan_intent' and state in (4, 5, 7, 9) and op_flag in ('I', 'U')
            and (state_changed or amount_changed or fund_code_changed or op_flag = 'I')
            and (ts is not null or old_dept_code is null) group by 1, 2""",  # a before image without a date is set aside
)
def stream_running_delta(spark, sf):
    """Changes from text in three micro-batches to every day's totals, updates corrected by their before images."""
    folder = shared_folder(spark, "delta")
    intents = fixtures.intent_rows(spark, sf).withColumn("part", F.col("intent_id") % 3)
    texts = fixtures.replayed(fixtures.cdc_json(intents, ("part",)), F.col("part"), 3, f"{folder}/in")
    connected, _ = connect_changes(texts, _orgs(spark, sf), "loan_intent", ZONE)
    rows, _ = parse.split_valid(cdc.unwrap_enriched(connected), F.lit(True))
    changed = F.col("state_changed") | F.col("amount_changed") | F.col("fund_code_changed") | (F.col("op_flag") == "I")
    rows = rows.where(changed & cdc.counted_state()).withColumn("day", epoch_to_text("event_ms", "yyyy-MM-dd", ZONE))
    running = RunningTotals(
        f"{folder}/totals", totals.delta_count(), totals.delta_amount(), ("I", "U"), attributes=REPORT_ATTRIBUTES, order=("event_ms", "intent_id")
    )
    _run(rows, "append", running, folder)
    return running.read(spark)


@query(
    "stream_retractions",
    "event_intents",
    """select strftime(ts, '%Y-%m-%d') as day, count(distinct dept_code) as n_depts, count(*) as lend_cnt, cast(sum(amount) as bigint) as lend_amount
        from event_intents group by 1""",
)
def stream_retractions(spark, sf):
    """A day's totals summed from the changes of its departments' reports, which come anew with every batch."""
    folder = shared_folder(spark, "retractions")
    rows = fixtures.view(spark, sf, "event_intents").select("intent_id", "dept_code", "amount", "ts")
    stream = fixtures.replayed(rows.withColumn("part", F.col("intent_id") % 3), F.col("part"), 3, f"{folder}/in")
    report = stream.groupBy(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("day"), "dept_code").agg(
        F.count(F.lit(1)).alias("lend_cnt"), F.sum("amount").alias("lend_amount")
    )
    changes = CommittedOutputs(f"{folder}/changes")
    table = sinks.UpsertTable(f"{folder}/table", ("day", "dept_code"), "lend_cnt", ("day",))
    _run(report, "update", retract_into(changes, table), folder)
    signed = [F.sum(F.col("sign") * F.col(c)).alias(c) for c in ("lend_cnt", "lend_amount")]
    return changes.read(spark, "changes").groupBy("day").agg(F.sum("sign").alias("n_depts"), *signed)


@query(
    "stream_ordered_changes",
    "event_intents",
    """select dept_code, count(*) as n_records, cast(sum(amount) as bigint) as amount from (
            select intent_id % 5000 as record, arg_max(dept_code, intent_id) as dept_code, arg_max(amount, intent_id) as amount
            from event_intents group by 1) x group by 1""",
)
def stream_ordered_changes(spark, sf):
    """Versions of records that come out of order and, a tenth of them, twice: totals per department of the last versions."""
    folder = shared_folder(spark, "ordered")
    rows = fixtures.view(spark, sf, "event_intents")
    rows = rows.select((F.col("intent_id") % 5000).alias("record"), F.col("intent_id").alias("version"), "dept_code", "amount", "ts")
    again = rows.where("version % 10 = 0").withColumn("part", F.lit(2))
    sent = rows.withColumn("part", F.lit(2) - F.col("version") % 3).unionByName(again.select(*rows.columns, F.col("part").cast("long")))
    stream = with_event_time(fixtures.replayed(sent, F.col("part"), 3, f"{folder}/in"), delay="60 days")
    stream = stream.dropDuplicatesWithinWatermark(["record", "version"]).drop("ts")
    changes = CommittedOutputs(f"{folder}/changes")
    table = sinks.UpsertTable(f"{folder}/table", ("record",), "version", ("record",))
    _run(stream, "append", ordered_into(changes, table, "version"), folder)
    signed = F.sum(F.col("sign") * F.col("amount")).alias("amount")
    return changes.read(spark, "changes").groupBy("dept_code").agg(F.sum("sign").alias("n_records"), signed)


@query(
    "stream_slot_report",
    "clicks",
    """select slot, app_id, func_id, org_code, max(window_end) as window_end, arg_max(pv, window_end) as pv,
        arg_max(uv, window_end) as uv from (
            select cast(day(ts) % 2 as varchar) as slot, app_id, func_id, org_code,
                make_timestamp((st + 3600) * 1000000) as window_end, strftime(ts, '%Y-%m-%d') as day,
                count(*) as pv, count(distinct user_id) as uv from (
                    select *, cast(floor(epoch(ts) / 300) * 300 as bigint) - 300 * i as st from clicks, range(12) t(i)) x
            where st <= epoch(ts) and epoch(ts) < st + 3600 group by all) y
        group by 1, 2, 3, 4""",
)
def stream_slot_report(spark, sf):
    """PV/UV upserted under a two-day slot: the latest window of a key wins, the target holds two days."""
    folder = shared_folder(spark, "slots")
    clicks = with_event_time(fixtures.closed_stream(fixtures.view(spark, sf, "clicks"), f"{folder}/in"), delay="60 seconds")
    timed = clicks.withColumn("action_day", F.date_format("ts", "yyyy-MM-dd"))
    keys = ("slot", "app_id", "func_id", "org_code")
    target = sinks.UpsertTable(f"{folder}/report", keys, ("window_end", "action_day"), ("slot",), load_time="optime")

    def slotted(report: DataFrame, batch_id: int) -> None:
        # A window over midnight has a row per day, so a key has one row per window within its slot.
        target(report.withColumn("slot", day_slot("action_day")), batch_id)

    report = HopReport(f"{folder}/windows", ["app_id", "func_id", "org_code", "action_day"], 3600, 300, delay=60, report_to=[slotted])
    _run(timed, "append", report, folder)
    current = target.read(spark).select("app_id", "func_id", "org_code", "window_end", "pv", "uv", F.col("slot").cast("string"))
    return _wall_clock(current)


def _clicks_stream(spark, sf, folder: str) -> DataFrame:
    return with_event_time(fixtures.closed_stream(fixtures.view(spark, sf, "clicks"), f"{folder}/in"))


@query(
    "stream_hot_topn",
    "ranked",
    """select window_end - interval '60' second as window_start, window_end, func_id, cnt, rank from ranked""",
)
def stream_hot_topn(spark, sf):
    """All counts of a closed window come in one batch, so each batch is ranked on its own."""
    folder = shared_folder(spark, "topn")
    counts = aggregates.hop_count(_clicks_stream(spark, sf, folder), ["func_id"], 60, 5)
    _run(counts, "append", sinks.append_to(f"{folder}/top", topn.top_n), folder)
    return _wall_clock(spark.read.parquet(f"{folder}/top").drop("batch_id"))


@query(
    "stream_misuse_alert",
    "clicks",
    f"""select user_id, min(ts) as alert_ts from clicks a where exists (
            select 1 from clicks b where b.user_id = a.user_id and b.func_id <> a.func_id
            and b.ts <= a.ts and b.ts >= a.ts - interval '{ALERT_GAP}' second)
        group by user_id, floor(epoch(ts) / {ALERT_GAP})""",
)
def stream_misuse_alert(spark, sf):
    folder = shared_folder(spark, "misuse")
    found = misuse.misuse_alerts(_clicks_stream(spark, sf, folder), ALERT_GAP)
    _run(found, "append", sinks.append_to(f"{folder}/alerts"), folder)
    return _wall_clock(spark.read.parquet(f"{folder}/alerts").drop("batch_id"))
