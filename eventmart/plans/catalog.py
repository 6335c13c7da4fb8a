"""Every operator as a named query over the given tables, next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import fixtures, schemas
from eventmart.functions import (
    clock_text,
    day_slot,
    day_text,
    epoch_ms,
    epoch_to_text,
    iso_utc,
    local_text,
    minute_text,
    parse_iso,
)
from eventmart.operators import alerts, cdc, enrich, late, merge, parse, topn, totals, windows
from eventmart.operators.lookup import dimension, lookup
from eventmart.plans import balance, jobs
from eventmart.session import shared_folder, written
from eventmart.sources import dims
from eventmart.streaming.upsert_table import UpsertTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ZONE = "Asia/Shanghai"  # eight hours ahead of UTC all year round
REPORT_DAY = "1998-06-15"
STAGED_FUNDS = ("2", "5")

# Derived relations the oracle texts build on, besides the plain views.
DERIVED = {
    "org": """select k as org_code, p[1] as dept_name, p[2] as busi_area_code, p[3] as busi_area_name,
        p[4] as admin_area_code, p[5] as admin_area_name, cast(len(p) as integer) as n_attrs
        from (select k, string_split(rtrim(v, ','), ',') as p from org_raw) s""",
    "org_next": """select k as org_code, p[1] as dept_name, p[2] as busi_area_code, p[3] as busi_area_name,
        p[4] as admin_area_code, p[5] as admin_area_name, cast(len(p) as integer) as n_attrs
        from (select k, string_split(rtrim(v, ','), ',') as p from org_raw_next) s""",
    "rows_": """select lid as intent_id, strdeptcode as dept_code, lamount as amount, nstate as state,
        nborrowmode as fund_code, lborrowerid as user_id, op_flag, strloandate as ts,
        strftime(strloandate, '%Y-%m-%d') as day, table_name, nstate_upd as state_changed,
        lamount_upd as amount_changed, nborrowmode_upd as fund_code_changed, old_lamount as old_amount,
        old_nstate as old_state, old_deptcode as old_dept_code from intents""",
    "tumbled": """select make_timestamp(cast(floor(epoch(ts) / 10) * 10 as bigint) * 1000000) as window_start,
        dept_code, max(ts) as last_ts, count(*) as lend_cnt from rows_ where ts is not null group by 1, 2""",
    "slide": """select make_timestamp((st + 60) * 1000000) as window_end, func_id, count(*) as cnt from (
            select *, cast(floor(epoch(ts) / 5) * 5 as bigint) - 5 * i as st from clicks, range(12) t(i)) x
        where st <= epoch(ts) and epoch(ts) < st + 60 group by 1, 2""",
    "ranked": """select *, cast(row_number() over (partition by window_end order by cnt desc, func_id) as integer)
        as rank from slide qualify rank <= 5""",
}
NEEDS = {
    "org": ["org_raw"],
    "org_next": ["org_raw_next"],
    "rows_": ["intents"],
    "tumbled": ["intents", "rows_"],
    "slide": ["clicks"],
    "ranked": ["clicks", "slide"],
}


def with_views(names: str, body: str) -> str:
    """The oracle text with the named views in front of it."""
    wanted: list[str] = []
    for name in names.split():
        for need in [*NEEDS.get(name, []), name]:
            if need not in wanted:
                wanted.append(need)
    ctes = [f"{n} as ({DERIVED[n] if n in DERIVED else fixtures.sql_of(n)})" for n in wanted]
    return f"with {', '.join(ctes)} {body}" if ctes else body


def query(name: str, views: str = "", sql: str | None = None):
    def register(func: Query) -> Query:
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return func

    return register


def _orgs(spark, sf):
    return dimension(dims.org_dimension(fixtures.view(spark, sf, "org_raw")), "org_code")


def _functions(spark, sf):
    # Distinct values of a large table: written once rather than derived for each use.
    return dimension(written(fixtures.view(spark, sf, "function_dim"), "functions"), "func_id")


def _users(spark, sf):
    return dimension(fixtures.view(spark, sf, "user_dim"), "user_id")


def _clicks(spark, sf):
    return fixtures.view(spark, sf, "clicks")


def _intents(spark, sf):
    return fixtures.intent_rows(spark, sf)


def _changes(spark, sf, keep=()):
    return cdc.parse_change(fixtures.cdc_json(_intents(spark, sf), keep), keep=keep)


# Amounts as they may be written: plain, in quotes, as decimal, as power of ten, with a fraction, and not at all.
_AMOUNT_FORMS = """case intent_id % 7 when 0 then cast(amount as {text}) when 1 then concat('"', cast(amount as {text}), '"')
        when 2 then concat(cast(amount as {text}), '.0') when 3 then concat('"', cast(amount as {text}), '.00"')
        when 4 then concat(cast(amount as {text}), 'e2') when 5 then concat(cast(amount as {text}), '.5') else '"n/a"' end"""


# --- sources and dimensions -------------------------------------------------------------------


@query(
    "strict_parse",
    "rows_ org",
    """select dept_code as deptcode, cast(intent_id as varchar) as "intentID", fund_code as nborrowmode,
        strftime(ts, '%Y-%m-%d %H:%M:%S') as strloandate, state as nstate, amount as lamount,
        cast(user_id as bigint) as userid, dept_name as deptname, busi_area_code as "busiAreaCode",
        busi_area_name as "busiAreaName", admin_area_code as "adminAreaCode", admin_area_name as "adminAreaName"
        from rows_ left join org on dept_code = org_code""",
)
def strict_parse(spark, sf):
    """A null member is there all the same: rows without organisation or date pass as well."""
    named = lookup(_intents(spark, sf), _orgs(spark, sf), "dept_code")
    text = F.to_json(
        F.struct(
            F.col("dept_code").alias("deptcode"),
            F.col("intent_id").cast("string").alias("intentID"),
            F.col("fund_code").alias("nborrowmode"),
            local_text("ts").alias("strloandate"),
            F.col("state").alias("nstate"),
            F.col("amount").alias("lamount"),
            F.col("user_id").cast("bigint").alias("userid"),
            F.col("dept_name").alias("deptname"),
            F.col("busi_area_code").alias("busiAreaCode"),
            F.col("busi_area_name").alias("busiAreaName"),
            F.col("admin_area_code").alias("adminAreaCode"),
            F.col("admin_area_name").alias("adminAreaName"),
        ),
        {"ignoreNullFields": "false"},
    )
    return parse.parse_json_strict(named.select(text.alias("value")), schemas.TABLE_INTENT)


_UNSENT = {"INT": "logType orgLevel", "VARCHAR": "bossUserId errorMsg funcName opName orgName requestInput requestUrl srcIp supOrgCode supOrgName userName"}


@query(
    "select_all",
    "clicks",
    f"""select app_id as "appId", func_id as "funcId", strftime(ts, '%Y-%m-%d %H:%M:%S') as "opDate",
        org_code as "orgCode", user_id as "userId", true as success,
        {", ".join(f'cast(null as {kind}) as "{c}"' for kind, names in _UNSENT.items() for c in names.split())}
        from clicks where event_id % 50 <> 0 and event_id % 51 <> 0""",
)
def select_all(spark, sf):
    """Every column of the declared table; its time stands here as the text that it came as."""
    parsed = parse.parse_json(fixtures.click_json(_clicks(spark, sf)), schemas.RAW_CLICK)
    good, _ = parse.split_valid(parsed, F.col("opDate").isNotNull())
    return spark.sql("select * from {log_table}", log_table=good)


@query("org_dim_parse", "org", "select * from org")
def org_dim_parse(spark, sf):
    return dims.org_dimension(fixtures.view(spark, sf, "org_raw"))


@query(
    "area_dim_invert",
    sql="select n_name as country, r_name as area from nation join region on n_regionkey = r_regionkey",
)
def area_dim_invert(spark, sf):
    return dims.area_dimension(fixtures.area_raw(spark, sf))


@query(
    "dim_repeated_keys",
    "item_records",
    """select l_orderkey, l_linenumber, country, case when country in ('FRANCE', 'CHINA') then 'ZONE' else r_name end as area
        from item_records left join nation on n_name = country left join region on n_regionkey = r_regionkey""",
)
def dim_repeated_keys(spark, sf):
    """Countries that two areas name, and trailing commas, multiply no record."""
    raw = fixtures.area_raw(spark, sf)
    raw = raw.unionByName(raw.limit(1).select(F.lit("ZONE").alias(raw.columns[0]), F.lit("FRANCE,CHINA,,").alias(raw.columns[1])))
    areas = dimension(dims.area_dimension(raw), "country")
    records = fixtures.view(spark, sf, "item_records").select("l_orderkey", "l_linenumber", "country")
    return lookup(records, areas, "country")


@query("dim_replace", "org_next", "select * from org_next")
def dim_replace(spark, sf):
    old, new = (dims.org_dimension(fixtures.view(spark, sf, v)) for v in ("org_raw", "org_raw_next"))
    return dims.replace_snapshot(old, new)


@query(
    "dim_merge",
    "org org_next",
    "select * from org_next union all select * from org where org_code not in (select org_code from org_next)",
)
def dim_merge(spark, sf):
    old, new = (dims.org_dimension(fixtures.view(spark, sf, v)) for v in ("org_raw", "org_raw_next"))
    return dims.merge_snapshot(old, new, "org_code")


# --- parsing and scalars ----------------------------------------------------------------------


@query(
    "parse_intent",
    "rows_",
    """select intent_id, coalesce(cast(epoch_ms(ts) as bigint), 0) as event_ms, dept_code,
        'dept ' || dept_code as dept_name, fund_code, amount, user_id, state, op_flag from rows_""",
)
def parse_intent(spark, sf):
    text = fixtures.flat_intent_json(_intents(spark, sf), keep=("intent_id",))
    return parse.parse_intent(text, keep=("intent_id",)).select(
        "intent_id", "event_ms", "dept_code", "dept_name", "fund_code", "amount", "user_id", "state", "op_flag"
    )


@query(
    "cdc_unwrap",
    "rows_",
    """select table_name, op_flag, intent_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as loan_date, fund_code, amount,
        state, dept_code, user_id, state_changed, amount_changed, fund_code_changed from rows_""",
)
def cdc_unwrap(spark, sf):
    return cdc.unwrap(_changes(spark, sf)).drop(parse.CORRUPT)


@query(
    "cdc_before_image",
    "rows_",
    """select intent_id, op_flag = 'U' as has_before, case when op_flag = 'U' then cast(intent_id as varchar) end as old_intent_id,
        case when op_flag = 'U' then strftime(ts, '%Y-%m-%d %H:%M:%S') end as old_loan_date,
        case when op_flag = 'U' then fund_code end as old_fund_code, cast(old_amount as varchar) as old_amount,
        cast(old_state as varchar) as old_state, old_dept_code,
        case when op_flag = 'U' then user_id end as old_user_id from rows_""",
)
def cdc_before_image(spark, sf):
    images = cdc.unwrap_before(_changes(spark, sf, ("intent_id",)), ("intent_id",))
    return images.withColumns({c: F.col(c).cast("string") for c in ("old_intent_id", "old_amount", "old_state")})


@query(
    "cdc_signed_pair",
    "rows_",
    """select intent_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as loan_date, fund_code, amount, state, dept_code,
        user_id, 'current' as image from rows_
        union all
        select intent_id, strftime(ts, '%Y-%m-%d %H:%M:%S'), fund_code, -old_amount, old_state, old_dept_code,
        user_id, 'before' from rows_ where op_flag = 'U'""",
)
def cdc_signed_pair(spark, sf):
    return cdc.signed_pair(_changes(spark, sf))


@query(
    "filter_table",
    "rows_",
    "select intent_id, table_name from rows_ where table_name = 'loan_intent'",
)
def filter_table(spark, sf):
    kept = cdc.filter_table(_changes(spark, sf), "loan_intent")
    return kept.select(F.col("lid.value").alias("intent_id"), F.col("tableName").alias("table_name"))


@query(
    "to_clean_json",
    "clicks function_dim user_dim org",
    """select event_id, '{"appId":"' || app_id || '","funcId":"' || func_id || '"'
        || coalesce(',"funcName":"' || func_name || '"', '')
        || case when event_id % 51 = 0 then '' else ',"stropDate":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"' end
        || ',"orgCode":"' || org_code || '","orgName":"' || coalesce(dept_name, '') || '","userId":"' || user_id || '"'
        || coalesce(',"userName":"' || user_name || '"', '')
        || case when event_id % 51 = 0 then '' else ',"logoptime":"'
           || strftime(ts - interval '8' hour, '%Y-%m-%dT%H:%M:%S') || '.000Z"' end || '}' as value
        from clicks left join function_dim using (func_id) left join user_dim using (user_id)
        left join org using (org_code) where event_id % 50 <> 0""",
)
def to_clean_json(spark, sf):
    return jobs.clean_clicks(
        fixtures.click_json(_clicks(spark, sf), keep=("event_id",)),
        _functions(spark, sf),
        _users(spark, sf),
        _orgs(spark, sf),
        ZONE,
        keep=("event_id",),
    )[0]


@query(
    "quarantine_clean_clicks",
    "clicks",
    """select event_id, case when event_id % 50 = 0 or event_id % 53 = 0 or event_id % 59 = 0 then 'unreadable'
        else 'sent' end as status from clicks""",
)
def quarantine_clean_clicks(spark, sf):
    """Every text is sent on or in quarantine: cut, null and blank ones; members nobody reads cost no record."""
    raw = fixtures.click_json(_clicks(spark, sf), keep=("event_id",))
    i = F.col("event_id")
    odd = F.regexp_replace("value", '"success":true', '"success":"true","logType":"2","orgLevel":""')
    raw = raw.withColumn(
        "value", F.when(i % 53 == 0, None).when(i % 59 == 0, "  ").when(i % 61 == 0, odd).otherwise(F.col("value"))
    )
    sent, bad = jobs.clean_clicks(raw, _functions(spark, sf), _users(spark, sf), _orgs(spark, sf), keep=("event_id",))
    return sent.select("event_id", F.lit("sent").alias("status")).unionByName(
        bad.select("event_id", F.lit("unreadable").alias("status"))
    )


@query(
    "quarantine_connect_changes",
    "rows_",
    """select intent_id, case when intent_id % 53 = 0 or intent_id % 59 = 0 or (op_flag = 'U' and ts is null)
            then 'quarantine' else 'sent' end as status
        from rows_ where table_name = 'loan_intent' or intent_id % 53 = 0 or intent_id % 59 = 0""",
)
def quarantine_connect_changes(spark, sf):
    """Texts that name no table since they cannot be read are in quarantine, not filtered out with other tables."""
    raw = fixtures.cdc_json(_intents(spark, sf), ("intent_id",))
    i = F.col("intent_id")
    raw = raw.withColumn("value", F.when(i % 53 == 0, None).when(i % 59 == 0, "garbage").otherwise(F.col("value")))
    sent, bad = jobs.connect_changes(raw, _orgs(spark, sf), "loan_intent", keep=("intent_id",))
    return sent.select("intent_id", F.lit("sent").alias("status")).unionByName(
        bad.select("intent_id", F.lit("quarantine").alias("status"))
    )


@query(
    "quarantine_split",
    "clicks",
    """select event_id, case when event_id % 50 = 0 then 'unreadable' when event_id % 51 = 0 then 'no time'
        else 'ok' end as status from clicks""",
)
def quarantine_split(spark, sf):
    raw = fixtures.click_json(_clicks(spark, sf), keep=("event_id",))
    parsed = parse.parse_json(raw, schemas.RAW_CLICK, keep=("event_id",))
    good, bad = parse.split_valid(parsed, iso_utc("opDate").isNotNull())
    reason = F.when(F.col(parse.CORRUPT).isNotNull(), "unreadable").otherwise("no time")
    return good.select("event_id", F.lit("ok").alias("status")).unionByName(
        bad.select("event_id", reason.alias("status"))
    )


_ITEMS = """select l_orderkey, l_linenumber, strftime(dt, '%Y-%m-%d %H:%M:%S') as dt, country as "countryCode",
    {area} type_1 as type, score_1 as score, level_1 as level from item_records {join}
    union all select l_orderkey, l_linenumber, strftime(dt, '%Y-%m-%d %H:%M:%S'), country,
    {area} type_2, score_2, level_2 from item_records {join}"""


@query("explode_items", "item_records", _ITEMS.format(area="", join=""))
def explode_items(spark, sf):
    keep = ("l_orderkey", "l_linenumber")
    text = fixtures.item_json(fixtures.view(spark, sf, "item_records"), keep)
    return parse.explode_items(parse.parse_json(text, schemas.NESTED_ITEMS, keep=keep), [*keep, "dt", "countryCode"])


@query(
    "enrich_area",
    "item_records",
    _ITEMS.format(
        area="r_name as area,",
        join="left join (select n_name, r_name from nation join region on n_regionkey = r_regionkey "
        "where r_name <> 'ASIA') a on n_name = country",
    ),
)
def enrich_area(spark, sf):
    keep = ("l_orderkey", "l_linenumber")
    text = fixtures.item_json(fixtures.view(spark, sf, "item_records"), keep)
    records = parse.parse_json(text, schemas.NESTED_ITEMS, keep=keep)
    known = dims.area_dimension(fixtures.area_raw(spark, sf)).where("area <> 'ASIA'")
    return enrich.area_of_items(records, dimension(known, "country"), keep)


@query("valid_event_time", "rows_", "select intent_id, ts from rows_ where ts is not null")
def valid_event_time(spark, sf):
    rows = _intents(spark, sf).withColumn("event_ms", F.coalesce(F.unix_millis(F.col("ts").cast("timestamp")), F.lit(0)))
    return rows.where(parse.valid_event_time()).select("intent_id", "ts")


@query("valid_state", "rows_", "select intent_id, state from rows_ where state in (4, 5, 7, 9)")
def valid_state(spark, sf):
    return _intents(spark, sf).where(cdc.counted_state()).select("intent_id", "state")


@query(
    "relevant_change",
    "rows_",
    f"""select intent_id, op_flag from rows_ where day = '{REPORT_DAY}'
        and (state_changed or amount_changed or fund_code_changed or op_flag = 'I')""",
)
def relevant_change(spark, sf):
    rows = _intents(spark, sf).withColumn("event_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return rows.where(cdc.relevant_change(REPORT_DAY)).select("intent_id", "op_flag")


@query(
    "iso_utc",
    "clicks",
    """select event_id, strftime(ts - interval '8' hour, '%Y-%m-%dT%H:%M:%S') || '.000Z' as shifted,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z' as unshifted from clicks""",
)
def iso_utc_query(spark, sf):
    text = _clicks(spark, sf).select("event_id", local_text("ts").alias("text"))
    return text.select(
        "event_id", iso_utc("text", ZONE).alias("shifted"), iso_utc("text", ZONE, shift=False).alias("unshifted")
    )


@query("parse_iso", "clicks", "select event_id, date_trunc('second', ts) as ts from clicks")
def parse_iso_query(spark, sf):
    text = _clicks(spark, sf).select("event_id", iso_utc(local_text("ts")).alias("text"))
    return text.select("event_id", parse_iso("text").cast("timestamp_ntz").alias("ts"))


@query(
    "epoch_ms",
    "rows_",
    """select intent_id, coalesce(cast(epoch_ms(ts - interval '8' hour) as bigint), 0) as ms,
        cast(cast(epoch_ms(ts - interval '8' hour) as bigint) as varchar) as before_ms from rows_""",
)
def epoch_ms_query(spark, sf):
    text = _intents(spark, sf).select("intent_id", local_text("ts").alias("text"))
    return text.select(
        "intent_id",
        epoch_ms("text", ZONE).alias("ms"),
        epoch_ms("text", ZONE, null_is_zero=False).cast("string").alias("before_ms"),
    )


@query(
    "epoch_to_text",
    "rows_",
    """select intent_id, strftime(ts + interval '8' hour, '%Y-%m-%d %H:%M:%S') as at,
        strftime(ts + interval '8' hour, '%Y-%m-%d') as day from rows_""",
)
def epoch_to_text_query(spark, sf):
    ms = _intents(spark, sf).select("intent_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return ms.select(
        "intent_id", epoch_to_text("ms", tz=ZONE).alias("at"), epoch_to_text("ms", "yyyy-MM-dd", ZONE).alias("day")
    )


@query(
    "minute_bucket",
    "clicks",
    """select event_id, strftime(ts, '%Y-%m-%d %H:%M') as action_minute, strftime(ts, '%H:%M') as action_clock,
        strftime(ts, '%Y-%m-%d') as action_day from clicks""",
)
def minute_bucket(spark, sf):
    text = _clicks(spark, sf).select("event_id", local_text("ts").alias("text"))
    return text.select(
        "event_id",
        minute_text("text").alias("action_minute"),
        clock_text("text").alias("action_clock"),
        day_text("text").alias("action_day"),
    )


@query("day_slot", "clicks", "select event_id, cast(day(ts) % 2 as varchar) as slot from clicks")
def day_slot_query(spark, sf):
    return _clicks(spark, sf).select("event_id", day_slot(local_text("ts")).alias("slot"))


# --- jobs from text to text -------------------------------------------------------------------


_ORG_JSON = """'"detpname":"' || {o}.dept_name || '","busiAreaCode":"' || {o}.busi_area_code
    || '","busiAreaName":"' || {o}.busi_area_name || '","adminAreaCode":"' || {o}.admin_area_code
    || '","adminAreaName":"' || {o}.admin_area_name || '"'"""


def _org_json(alias: str) -> str:
    return _ORG_JSON.format(o=alias)


_FULL = "(select * from org where n_attrs = 5)"


@query(
    "connect_intents",
    "rows_ org",
    f"""select intent_id, '{{"strloandate":' || coalesce(cast(epoch_ms(ts) as bigint), 0) || ',"strdeptcode":"' || dept_code
        || '","nborrowmode":"' || fund_code || '","lamount":' || amount || ',"userid":"' || user_id || '","nstate":'
        || state || ',"opFlag":"' || op_flag || '",' || {_org_json('o')}
        || case when old_dept_code is null then '' else ',"beforeRecord":{{"strdeptcode":"' || old_dept_code
           || '","lamount":' || old_amount || ',"nstate":' || old_state || ',' || {_org_json('p')} || '}}' end || '}}' as value
        from rows_ join {_FULL} o on o.org_code = dept_code left join {_FULL} p on p.org_code = old_dept_code
        where old_dept_code is null or p.org_code is not null""",
)
def connect_intents(spark, sf):
    text = fixtures.flat_intent_json(_intents(spark, sf), keep=("intent_id",), before=True)
    return jobs.connect_intents(text, _orgs(spark, sf), keep=("intent_id",))[0]


@query(
    "dept_report_from_text",
    "rows_ org",
    f"""select window_start, window_start + interval '10' second as window_end, dept_code, count(*) as lend_cnt,
        cast(sum(amount) as bigint) as lend_amount, max(ts) as last_ts,
        {", ".join(f"max({c}) as {c}" for c in enrich.OTHER_ORG)}, arg_max(fund_code, (ts, user_id, fund_code)) as fund_code
        from (select r.*, o.*, make_timestamp(cast(floor(epoch(ts) / 10) * 10 as bigint) * 1000000) as window_start
            from rows_ r join {_FULL} o on o.org_code = r.dept_code left join {_FULL} p on p.org_code = r.old_dept_code
            where ts is not null and (old_dept_code is null or p.org_code is not null)) x
        group by window_start, dept_code""",
)
def dept_report_from_text(spark, sf):
    """Intents from text to text to the department's report, with every attribute."""
    raw = fixtures.flat_intent_json(_intents(spark, sf), before=True)
    texts, _ = jobs.connect_intents(raw, _orgs(spark, sf))
    return jobs.dept_report(texts)[0]


def _cell_json(name: str, value: str, flag: str = "false", quote: bool = False) -> str:
    """SQL for `"name":{"value":..,"isupdate":..}`; a null value leaves the member out."""
    shown = f"""'"value":"' || {value} || '",'""" if quote else f"""'"value":' || {value} || ','"""
    return f"""'"{name}":{{' || coalesce({shown}, '') || '"isupdate":' || {flag} || '}}'"""


_CHANGE_CELLS = " || ',' || ".join(
    [
        _cell_json("lid", "intent_id"),
        _cell_json("nborrowmode", "fund_code", "fund_code_changed", True),
        _cell_json("lamount", "amount", "amount_changed"),
        _cell_json("nstate", "state", "state_changed"),
        _cell_json("strdeptcode", "dept_code", quote=True),
        _cell_json("lborrowerid", "user_id", quote=True),
    ]
)
_OLD_CELLS = " || ',' || ".join(
    [
        _cell_json("lid", "intent_id"),
        _cell_json("nborrowmode", "fund_code", quote=True),
        _cell_json("lamount", "old_amount"),
        _cell_json("nstate", "old_state"),
        _cell_json("strdeptcode", "old_dept_code", quote=True),
        _cell_json("lborrowerid", "user_id", quote=True),
    ]
)
_OTHER = "(select {})".format(", ".join(f"'{v}' as {c}" for c, v in enrich.OTHER_ORG.items()))
_FILLED = "(select org_code, {} from org where n_attrs = 5)".format(", ".join(enrich.OTHER_ORG))


def _filled(alias: str, key: str) -> str:
    """The organisation of a department as a one-row subquery with the default bucket filled in."""
    columns = ", ".join(f"coalesce({alias}_.{c}, {alias}_d.{c}) as {c}" for c in enrich.OTHER_ORG)
    return f"""(select k, {columns} from (select distinct {key} as k from rows_) {alias}_k
        cross join {_OTHER} {alias}_d left join {_FILLED} {alias}_ on {alias}_.org_code = k)"""


@query(
    "connect_changes",
    "rows_ org",
    f"""select intent_id, '{{"tableName":"' || table_name || '","opFlag":"' || op_flag || '",' || {_CHANGE_CELLS}
        || ',"strloandate":' || coalesce(cast(epoch_ms(ts - interval '8' hour) as bigint), 0) || ',' || {_org_json('o')}
        || case when op_flag <> 'U' then '' else ',"beforeRecord":{{' || {_OLD_CELLS} || ',"strloandate":'
           || cast(epoch_ms(ts - interval '8' hour) as bigint) || ',' || {_org_json('p')} || '}}' end || '}}' as value
        from rows_ join {_filled('o', 'dept_code')} o on o.k = dept_code
        left join {_filled('p', 'old_dept_code')} p on p.k = old_dept_code
        where table_name = 'loan_intent' and (op_flag <> 'U' or ts is not null)""",
)
def connect_changes(spark, sf):
    text = fixtures.cdc_json(_intents(spark, sf), keep=("intent_id",))
    return jobs.connect_changes(text, _orgs(spark, sf), "loan_intent", ZONE, keep=("intent_id",))[0]


@query(
    "delta_report_from_text",
    "rows_ org",
    f"""select day, dept_code, count(*) as lend_cnt,
        cast(sum(case when op_flag = 'I' then amount
            else amount - case when old_state in (4, 5, 7, 9) then old_amount else 0 end end) as bigint) as lend_amount,
        count(distinct user_id) as user_cnt, {", ".join(f"max(o.{c}) as {c}" for c in enrich.OTHER_ORG)},
        arg_max(fund_code, (ts, intent_id)) as fund_code
        from rows_ join {_filled('o', 'dept_code')} o on o.k = dept_code
        where table_name = 'loan_intent' and day = '{REPORT_DAY}' and state in (4, 5, 7, 9) and op_flag in ('I', 'U')
            and (state_changed or amount_changed or fund_code_changed or op_flag = 'I') group by 1, 2""",
)
def delta_report_from_text(spark, sf):
    """The report over the texts that the enrichment of changes writes."""
    changes = fixtures.cdc_json(_intents(spark, sf))
    texts, _ = jobs.connect_changes(changes, _orgs(spark, sf), "loan_intent", ZONE)
    return jobs.delta_report(texts, REPORT_DAY, ZONE)[0]


@query(
    "flatten_changes",
    "rows_ org",
    f"""select '{{"fundcode":"' || fund_code || '","deptcode":"' || dept || '","loandate":"'
        || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","dataOPFlag":"' || image || '","detpname":"' || dept_name
        || '","user_id":"' || user_id || '","busiAreaCode":"' || busi_area_code || '","nstate":' || s
        || ',"intent_id":' || intent_id || ',"adminAreaCode":"' || admin_area_code || '","adminAreaName":"'
        || admin_area_name || '","busiAreaName":"' || busi_area_name || '","lamount":' || a
        || ',"eventtime":' || cast(epoch_ms(ts) as bigint) || '}}' as value from (
            select *, dept_code as dept, amount as a, state as s, 'current' as image from rows_
            union all select *, old_dept_code, -old_amount, old_state, 'before' from rows_ where op_flag = 'U') x
        join {_FULL} o on org_code = dept where ts is not null""",
)
def flatten_changes(spark, sf):
    return jobs.flatten_changes(fixtures.cdc_json(_intents(spark, sf)), _orgs(spark, sf))[0]


@query(
    "table_intents",
    "rows_ org",
    """select '{"deptcode":"' || dept_code || '","intentID":"' || intent_id || '","nborrowmode":"' || fund_code || '"'
        || coalesce(',"strloandate":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"', '') || ',"nstate":' || state
        || ',"lamount":' || amount || ',"userid":' || user_id || ',"deptname":"' || dept_name || '","busiAreaCode":"'
        || busi_area_code || '","busiAreaName":"' || busi_area_name || '"'
        || coalesce(',"adminAreaCode":"' || admin_area_code || '","adminAreaName":"' || admin_area_name || '"', '')
        || '}' as value from rows_ join org on org_code = dept_code""",
)
def table_intents(spark, sf):
    return jobs.table_intents(fixtures.cdc_json(_intents(spark, sf)), _orgs(spark, sf))[0]


@query(
    "clean_items",
    "item_records",
    """select '{"type":"' || type || '","score":' || score || ',"level":"' || level || '"'
        || coalesce(',"area":"' || area || '"', '') || ',"dt":"' || strftime(dt, '%Y-%m-%d %H:%M:%S') || '"}' as value
        from (select type_1 as type, score_1 as score, level_1 as level, country, dt from item_records
            union all select type_2, score_2, level_2, country, dt from item_records) x
        left join (select n_name, r_name as area from nation join region on n_regionkey = r_regionkey
            where r_name <> 'ASIA') a on n_name = country""",
)
def clean_items(spark, sf):
    known = dims.area_dimension(fixtures.area_raw(spark, sf)).where("area <> 'ASIA'")
    return jobs.clean_items(fixtures.item_json(fixtures.view(spark, sf, "item_records")), dimension(known, "country"))[0]


# --- joins ------------------------------------------------------------------------------------


@query(
    "enrich_names_left",
    "clicks function_dim user_dim",
    """select event_id, func_id, user_id, func_name, user_name from clicks
        left join function_dim using (func_id) left join user_dim using (user_id)""",
)
def enrich_names_left(spark, sf):
    clicks = _clicks(spark, sf).select("event_id", "func_id", "user_id")
    return enrich.names_left(clicks, _functions(spark, sf), _users(spark, sf))


@query(
    "enrich_names_inner",
    "clicks function_dim user_dim",
    """select event_id, func_id, user_id, func_name, user_name from clicks
        join function_dim using (func_id) join user_dim using (user_id)""",
)
def enrich_names_inner(spark, sf):
    clicks = _clicks(spark, sf).select("event_id", "func_id", "user_id")
    return enrich.names_inner(clicks, _functions(spark, sf), _users(spark, sf))


@query(
    "enrich_org_name",
    "clicks org",
    "select event_id, org_code, coalesce(dept_name, '') as org_name from clicks left join org using (org_code)",
)
def enrich_org_name(spark, sf):
    return enrich.org_name(_clicks(spark, sf).select("event_id", "org_code"), _orgs(spark, sf))


@query(
    "enrich_fail_open",
    "clicks org",
    """select event_id, org_code, coalesce(dept_name, '') as org_name, true as answered
        from clicks left join org using (org_code)
        union all select event_id, org_code, 'as sent', false from clicks""",
)
def enrich_fail_open(spark, sf):
    clicks = _clicks(spark, sf).select("event_id", "org_code", F.lit("as sent").alias("org_name"))
    orgs = _orgs(spark, sf)
    return enrich.org_fail_open(clicks, orgs, True).withColumn("answered", F.lit(True)).unionByName(
        enrich.org_fail_open(clicks, orgs, False).withColumn("answered", F.lit(False))
    )


_ORG_LIST = "dept_name, busi_area_code, busi_area_name, admin_area_code, admin_area_name"


@query(
    "enrich_org_strict",
    "rows_ org",
    f"select intent_id, dept_code, amount, {_ORG_LIST} from rows_ join org on dept_code = org_code where n_attrs = 5",
)
def enrich_org_strict(spark, sf):
    rows = _intents(spark, sf).select("intent_id", "dept_code", "amount")
    return enrich.org_strict(rows, _orgs(spark, sf))[0]


@query(
    "enrich_org_misses",
    "rows_ org",
    """select intent_id, dept_code, amount from rows_
        where dept_code not in (select org_code from org where n_attrs = 5)""",
)
def enrich_org_misses(spark, sf):
    rows = _intents(spark, sf).select("intent_id", "dept_code", "amount")
    return enrich.org_strict(rows, _orgs(spark, sf))[1]


def _default_sql(alias: str, prefix: str = "", only_if: str = "true") -> str:
    return ", ".join(
        f"case when {only_if} then coalesce({alias}.{c}, '{v}') end as {prefix}{c}" for c, v in enrich.OTHER_ORG.items()
    )


@query(
    "enrich_org_default",
    "rows_ org",
    f"""select intent_id, dept_code, {_default_sql('o')} from rows_
        left join (select * from org where n_attrs = 5) o on dept_code = org_code""",
)
def enrich_org_default(spark, sf):
    return enrich.org_default(_intents(spark, sf).select("intent_id", "dept_code"), _orgs(spark, sf))


@query(
    "enrich_before_after",
    "rows_ org",
    f"""select intent_id, dept_code, old_dept_code, {_default_sql('o')},
        {_default_sql('p', 'old_', 'old_dept_code is not null')} from rows_
        left join (select * from org where n_attrs = 5) o on dept_code = o.org_code
        left join (select * from org where n_attrs = 5) p on old_dept_code = p.org_code""",
)
def enrich_before_after(spark, sf):
    rows = _intents(spark, sf).select("intent_id", "dept_code", "old_dept_code")
    return enrich.before_after(rows, _orgs(spark, sf))


# --- windows, totals, ranking -----------------------------------------------------------------


def _dated(spark, sf):
    return _intents(spark, sf).where("ts is not null")


@query(
    "tumble_count",
    "tumbled",
    """select window_start, window_start + interval '10' second as window_end, dept_code,
        strftime(last_ts, '%Y-%m-%d %H:%M:%S') as event_time, lend_cnt from tumbled""",
)
def tumble_count(spark, sf):
    return windows.tumble_count(_dated(spark, sf))


@query(
    "tumble_report",
    "tumbled rows_",
    """select window_start, window_start + interval '10' second as window_end, dept_code, count(*) as lend_cnt,
        cast(sum(amount) as bigint) as lend_amount, max(ts) as last_ts,
        arg_max(fund_code, (ts, intent_id, fund_code)) as fund_code from (
            select *, make_timestamp(cast(floor(epoch(ts) / 10) * 10 as bigint) * 1000000) as window_start
            from rows_ where ts is not null) x group by 1, 2, 3""",
)
def tumble_report(spark, sf):
    return windows.tumble_report(_dated(spark, sf), ["fund_code"])


def _hop_sql(size: int, slide: int, keys: str, views: str = "clicks") -> str:
    panes = -(-size // slide)
    return f"""select make_timestamp(st * 1000000) as window_start, make_timestamp((st + {size}) * 1000000) as window_end,
        {keys}, count(*) as pv, count(distinct user_id) as uv from (
            select *, strftime(ts, '%Y-%m-%d') as action_day, strftime(ts, '%Y-%m-%d %H:%M') as action_minute,
                strftime(ts, '%H:%M') as action_clock,
                cast(floor(epoch(ts) / {slide}) * {slide} as bigint) - {slide} * i as st
            from named, range({panes}) t(i)) x
        where st <= epoch(ts) and epoch(ts) < st + {size} group by all"""


_NAMED = """named as (select event_id, app_id, func_id, func_name, org_code, coalesce(dept_name, '') as org_name,
    user_id, ts from clicks left join function_dim using (func_id) left join org using (org_code))"""


def _hop_oracle(size: int, slide: int, keys: str) -> str:
    return with_views("clicks function_dim org", f", {_NAMED} {_hop_sql(size, slide, keys)}")


@query("hop_pv_uv_hour")
def hop_pv_uv_hour(spark, sf):
    functions, orgs = _functions(spark, sf), _orgs(spark, sf)
    return jobs.click_report(_clicks(spark, sf), functions, orgs, 3600, 300, "day", {"action_day": day_text})


ORACLES["hop_pv_uv_hour"] = _hop_oracle(3600, 300, "app_id, func_id, org_code, func_name, org_name, action_day")


@query("hop_pv_uv_minute")
def hop_pv_uv_minute(spark, sf):
    functions, orgs = _functions(spark, sf), _orgs(spark, sf)
    texts = {"action_minute": minute_text, "action_clock": clock_text}
    return jobs.click_report(_clicks(spark, sf), functions, orgs, 70, 3, "minute", texts)


ORACLES["hop_pv_uv_minute"] = _hop_oracle(
    70, 3, "app_id, func_id, org_code, func_name, org_name, action_minute, action_clock"
)


@query(
    "slide_count",
    "slide",
    "select window_end - interval '60' second as window_start, window_end, func_id, cnt from slide",
)
def slide_count(spark, sf):
    counts = windows.hop_count(_clicks(spark, sf), ["func_id"], 60, 5)
    return counts.withColumn("cnt", F.col("cnt").cast("bigint"))


@query(
    "hot_topn",
    "ranked",
    "select window_end - interval '60' second as window_start, window_end, func_id, cnt, rank from ranked",
)
def hot_topn(spark, sf):
    return topn.hot_functions(_clicks(spark, sf))


@query(
    "hot_report_text",
    "ranked",
    f"""select window_end, '{topn.HEAD}' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
        || string_agg('{topn.RANK}' || rank || '{topn.FUNCTION}' || func_id || '{topn.VIEWS}' || cnt || chr(10)
            || '{topn.RULE}' || chr(10), '' order by rank) as report
        from ranked group by window_end""",
)
def hot_report_text(spark, sf):
    return topn.ranking_text(topn.hot_functions(_clicks(spark, sf)))


@query(
    "running_totals",
    "rows_",
    """select coalesce(day, '1970-01-01') as day, dept_code,
        cast(sum(case when op_flag in ('I', 'U') then 1 else -1 end) as bigint) as lend_cnt,
        cast(sum(case when op_flag in ('I', 'U') then amount else -amount end) as bigint) as lend_amount,
        count(distinct user_id) as user_cnt from rows_ where state = 9 group by 1, 2""",
)
def running_totals(spark, sf):
    # A record without a date has event time 0, which this report keeps.
    rows = _intents(spark, sf).where(F.col("state") == cdc.SETTLED_STATE)
    return totals.running_totals(rows.withColumn("day", F.coalesce("day", F.lit("1970-01-01"))))


@query(
    "running_delta",
    "rows_",
    """select day, dept_code, count(*) as lend_cnt,
        cast(sum(case when op_flag = 'I' then amount
            else amount - case when old_state in (4, 5, 7, 9) then old_amount else 0 end end) as bigint) as lend_amount,
        count(distinct user_id) as user_cnt from rows_
        where state in (4, 5, 7, 9) and op_flag in ('I', 'U') and day is not null group by 1, 2""",
)
def running_delta(spark, sf):
    return totals.running_delta(_dated(spark, sf).where(cdc.counted_state()))


@query(
    "running_net",
    "rows_",
    """select day, dept_code, cast(sum(step) as bigint) as lend_cnt, cast(sum(amount) as bigint) as lend_amount,
        count(distinct user_id) as user_cnt from (
            select day, dept_code, 1 as step, amount, user_id from rows_
            union all select day, old_dept_code, -1, -old_amount, user_id from rows_ where op_flag = 'U') x
        where day is not null group by 1, 2""",
)
def running_net(spark, sf):
    pairs = cdc.signed_pair(_changes(spark, sf)).withColumn("day", day_text("loan_date"))
    return totals.net_totals(pairs.where("day is not null"))


@query("distinct_users", "rows_", "select dept_code, count(distinct user_id) as user_cnt from rows_ group by 1")
def distinct_users(spark, sf):
    return totals.distinct_users(_intents(spark, sf))


@query(
    "late_router",
    "arrivals",
    """select event_id, coalesce(make_timestamp(cast(floor(epoch(ts) / 10) * 10 + 10 as bigint) * 1000000)
            + interval '5' second <= max(ts) over (order by arrival, event_id
                rows between unbounded preceding and 1 preceding) - interval '10' second, false) as is_late
        from arrivals""",
)
def late_router(spark, sf):
    return late.mark_late(fixtures.view(spark, sf, "arrivals")).select("event_id", "is_late")


ALERT_GAP = 3600


@query(
    "misuse_alert",
    "clicks",
    f"""select user_id, min(ts) as alert_ts from clicks a where exists (
            select 1 from clicks b where b.user_id = a.user_id and b.func_id <> a.func_id
            and b.ts <= a.ts and b.ts >= a.ts - interval '{ALERT_GAP}' second)
        group by user_id, floor(epoch(ts) / {ALERT_GAP})""",
)
def misuse_alert(spark, sf):
    return alerts.misuse_alerts(_clicks(spark, sf), ALERT_GAP)


@query(
    "misuse_alert_text",
    "clicks",
    f"""select user_id, alert_ts, '{alerts.ALERT_HEAD}' || user_id || '{alerts.ALERT_TAIL}' as alert from (
            select user_id, min(ts) as alert_ts from clicks a where exists (
                select 1 from clicks b where b.user_id = a.user_id and b.func_id <> a.func_id
                and b.ts <= a.ts and b.ts >= a.ts - interval '{ALERT_GAP}' second)
            group by user_id, floor(epoch(ts) / {ALERT_GAP})) x""",
)
def misuse_alert_text(spark, sf):
    return alerts.alert_text(alerts.misuse_alerts(_clicks(spark, sf), ALERT_GAP))


@query(
    "misuse_alert_ever",
    "clicks",
    f"""select user_id, min(ts) as alert_ts from clicks a join (
            select user_id, min(ts) as since from clicks c where exists (
                select 1 from clicks b where b.user_id = c.user_id and b.func_id <> c.func_id and b.ts <= c.ts)
            group by user_id) s using (user_id)
        where ts >= since group by user_id, floor(epoch(ts) / {ALERT_GAP})""",
)
def misuse_alert_ever(spark, sf):
    return alerts.misuse_alerts_ever(_clicks(spark, sf), ALERT_GAP)


# --- sinks as transforms ----------------------------------------------------------------------

SPLIT_DAY = "2024-01-16"
_DAILY = """daily as (select cast(day(ts) % 2 as varchar) as slot, app_id, func_id, strftime(ts, '%Y-%m-%d') as day,
    count(*) as pv from clicks group by 1, 2, 3, 4)"""


def _daily(spark, sf):
    clicks = _clicks(spark, sf)
    slot = day_slot(local_text("ts")).alias("slot")
    return clicks.groupBy(slot, "app_id", "func_id", day_text(local_text("ts")).alias("day")).agg(F.count(F.lit(1)).alias("pv"))


@query("sink_upsert")
def sink_upsert(spark, sf):
    """Four batches by day into an upsert table, the last one written twice, merged into levels on the way."""
    daily = _daily(spark, sf)
    table = UpsertTable(f"{shared_folder(spark, 'upsert')}/t", ("slot", "app_id", "func_id"), "day", ("slot",), fanout=3)
    parts = daily.withColumn("__part", F.when(F.col("day") < SPLIT_DAY, 0).otherwise(1))
    steps = [parts.where("__part = 0 and slot = '0'"), parts.where("__part = 0 and slot = '1'"), parts.where("__part = 1")]
    for batch_id, step in enumerate([*steps, daily.limit(0)]):
        table(step.drop("__part"), batch_id)
    table(daily.limit(0), 3)
    return table.read(spark)


ORACLES["sink_upsert"] = with_views(
    "clicks",
    f""", {_DAILY} select slot, app_id, func_id, max(day) as day, arg_max(pv, day) as pv
        from daily group by 1, 2, 3""",
)


@query("change_label")
def change_label(spark, sf):
    clicks = _clicks(spark, sf)

    def per_user(rows):
        return rows.groupBy("user_id", "func_id").agg(F.count(F.lit(1)).alias("pv"))

    return merge.change_label(per_user(clicks.where(F.col("ts") < SPLIT_DAY)), per_user(clicks), ["user_id", "func_id"])


ORACLES["change_label"] = with_views(
    "clicks",
    f"""select user_id, func_id, count(*) as pv,
        case when count(*) filter (ts < timestamp '{SPLIT_DAY}') = 0 then 'insert'
             when count(*) filter (ts < timestamp '{SPLIT_DAY}') = count(*) then 'same' else 'update' end as change
        from clicks group by 1, 2""",
)


@query(
    "index_documents",
    "tumbled",
    """select '{"eventTime":"' || strftime(last_ts, '%Y-%m-%d %H:%M:%S') || '","deptcode":"' || dept_code
        || '","lendCnt":"' || lend_cnt || '"}' as document from tumbled""",
)
def index_documents(spark, sf):
    counts = windows.tumble_count(_dated(spark, sf)).select("event_time", "dept_code", "lend_cnt")
    return merge.documents(counts, {"event_time": "eventTime", "dept_code": "deptcode", "lend_cnt": "lendCnt"})


@query(
    "kv_list_push",
    "tumbled",
    """select dept_code as list_key, cast(lend_cnt as varchar) as list_value,
        window_start + interval '10' second as window_end from tumbled""",
)
def kv_list_push(spark, sf):
    return merge.list_pushes(windows.tumble_count(_dated(spark, sf)), "dept_code", "lend_cnt", "window_end")


# --- batch report -----------------------------------------------------------------------------


def balance_inputs(spark, sf) -> balance.BalanceInputs:
    return balance.BalanceInputs(
        applications=fixtures.view(spark, sf, "applications"),
        repayments=fixtures.view(spark, sf, "repayments"),
        funds=written(fixtures.view(spark, sf, "funds"), "funds"),
        intents=_intents(spark, sf),
        bills=fixtures.view(spark, sf, "bills"),
        bad_debts=fixtures.view(spark, sf, "bad_debts"),
        orgs=dims.org_dimension(fixtures.view(spark, sf, "org_raw")),
    )


_D = f"date '{REPORT_DAY}'"
_IN_STAGED = "in (" + ", ".join(f"'{f}'" for f in STAGED_FUNDS) + ")"
BALANCE_SQL = {
    "g": f"""select '{balance.OTHER_DEPT}' as dept_code,
        cast((select coalesce(sum(amount), 0) from applications
            where apply_status = '2' and amount >= 0 and success_date < {_D})
        - (select coalesce(sum(principal), 0) from repayments
            where repay_status = '2' and repay_date < {_D}) as bigint) as balance_1""",
    "r": f"""select b.dept_code,
        cast(sum(case when b.fund_code not {_IN_STAGED} and b.state = 9 then principal else 0 end) as bigint) as repaid_plain,
        cast(sum(case when b.fund_code {_IN_STAGED} and b.state = 9 then principal else 0 end) as bigint) as repaid_staged,
        cast(sum(case when b.state = 32 then principal else 0 end) as bigint) as instalments
        from (select fund_code from funds where business_type = 0) f
        join (select * from rows_ where state in (4, 5, 7, 9, 32)) a on f.fund_code = a.fund_code
        join (select * from bills where state in (9, 32) and principal > 0 and repay_date < {_D}) b
            on a.intent_id = b.intent_id group by b.dept_code""",
    "l": f"""select dept_code,
        cast(coalesce(sum(case when a.fund_code not {_IN_STAGED} then amount end), 0) as bigint) as lent_plain,
        cast(coalesce(sum(case when a.fund_code {_IN_STAGED} then amount end), 0) as bigint) as lent_staged
        from (select fund_code from funds where business_type = 0) f join (select * from rows_ where ts is not null
            and day < '{REPORT_DAY}' and state in (4, 5, 7, 9, 32) and amount > 0) a on f.fund_code = a.fund_code
        group by dept_code""",
    "d": """select dept_code, cast(sum(lent - repaid - instalments) as bigint) as balance_2 from (
            select dept_code, 0 as lent, repaid_plain + repaid_staged as repaid, instalments from r
            union all select dept_code, lent_plain + lent_staged, 0, 0 from l) x group by dept_code""",
    "b": f"""select dept_code,
        cast(coalesce(sum(case when day = {_D} - 1 then bad_debt end), 0)
        - coalesce(sum(case when day = {_D} - 2 then bad_debt end), 0) as bigint) as bad_debt_change
        from bad_debts group by dept_code""",
    "report": f"""select coalesce(org_code, '{balance.OTHER_DEPT}') as dept,
        cast(coalesce(sum(balance_1), 0) * 100 as bigint) as balance_1,
        cast(coalesce(sum(balance_2), 0) as bigint) as balance_2,
        cast(coalesce(sum(bad_debt_change), 0) as bigint) as bad_debt_change, strftime({_D} - 1, '%Y-%m-%d') as strdate
        from (select dept_code, balance_1, 0 as balance_2, 0 as bad_debt_change from g
            union all select dept_code, 0, balance_2, 0 from d
            union all select dept_code, 0, 0, bad_debt_change from b) x
        left join org on org_code = dept_code group by 1""",
}


def _balance_oracle(last: str, steps: str = "") -> str:
    views = with_views("rows_ org funds bills applications repayments bad_debts", "")
    chain = "".join(f", {s} as ({BALANCE_SQL[s]})" for s in steps.split())
    return f"{views}{chain} {BALANCE_SQL[last]}"


@query("balance_global")
def balance_global(spark, sf):
    return balance.balance_global(balance_inputs(spark, sf), REPORT_DAY)


@query("balance_repaid")
def balance_repaid(spark, sf):
    return balance.balance_repaid(balance_inputs(spark, sf), REPORT_DAY, STAGED_FUNDS)


@query("balance_lent")
def balance_lent(spark, sf):
    return balance.balance_lent(balance_inputs(spark, sf), REPORT_DAY, STAGED_FUNDS)


@query("balance_by_dept")
def balance_by_dept(spark, sf):
    return balance.balance_by_dept(balance_inputs(spark, sf), REPORT_DAY, STAGED_FUNDS)


@query("day_over_day")
def day_over_day(spark, sf):
    return balance.day_over_day(balance_inputs(spark, sf), REPORT_DAY)


@query("balance_report")
def balance_report(spark, sf):
    return balance.balance_report(balance_inputs(spark, sf), REPORT_DAY, STAGED_FUNDS)


ORACLES |= {
    "balance_global": _balance_oracle("g"),
    "balance_repaid": _balance_oracle("r"),
    "balance_lent": _balance_oracle("l"),
    "balance_by_dept": _balance_oracle("d", "r l"),
    "day_over_day": _balance_oracle("b"),
    "balance_report": _balance_oracle("report", "g r l d b"),
}


@query(
    "parse_decimals",
    "rows_",
    """select intent_id, state, case intent_id % 7 when 4 then amount * 100 when 5 then null when 6 then null else amount end as amount,
        intent_id % 7 >= 5 as set_aside from rows_""",
)
def parse_decimals(spark, sf):
    """Whole amounts in every way they may be written; records whose amount cannot be read are set aside."""
    amount = F.expr(_AMOUNT_FORMS.format(text="string"))
    text = F.concat(F.lit('{"lamount":'), amount, F.lit(',"nstate":"'), F.col("state").cast("string"), F.lit('.0"}'))
    texts = _intents(spark, sf).select("intent_id", text.alias("value"))
    columns = ["intent_id", "state", "amount"]
    # Written once: both sides of the split would parse all texts.
    parsed = written(parse.parse_intent(texts, keep=["intent_id"]).select(*columns, parse.CORRUPT), "parsed")
    good, bad = parse.split_valid(parsed, F.lit(True))
    both = good.select(*columns, F.lit(False).alias("set_aside"))
    return both.unionByName(bad.select(*columns, F.lit(True).alias("set_aside")))
