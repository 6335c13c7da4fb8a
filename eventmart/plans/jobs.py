"""The jobs end to end: JSON text in, JSON text or report rows out.

Each is a DataFrame function without a shuffle of its own (reports apart), so it serves a batch of
texts and a stream of texts alike. Rows a job cannot process come back in a second frame: every text is sent on, filtered by a rule, or in it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.functions import epoch_ms, epoch_to_text, local_text
from eventmart.operators import cdc, enrich, parse, totals, windows
from eventmart.operators.lookup import Dimension, lookup

ID_KEYS = ("app_id", "func_id", "org_code")

# Member names of the organisation attributes in JSON records.
ORG_MEMBERS = {
    "dept_name": "detpname",
    "busi_area_code": "busiAreaCode",
    "busi_area_name": "busiAreaName",
    "admin_area_code": "adminAreaCode",
    "admin_area_name": "adminAreaName",
}


def _org_members(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{column}").alias(member) for column, member in ORG_MEMBERS.items()]


def clean_clicks(
    raw: DataFrame,
    functions: Dimension,
    users: Dimension,
    orgs: Dimension,
    tz: str = "UTC",
    how: str = "left",
    shift: bool = True,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Raw click texts to clean click texts: one parse of the members used, three lookups, one serialisation.

    `how="inner"` drops clicks whose function or user is unknown, `left` leaves the name out.
    """
    used = schemas.struct(**{c: schemas.RAW_CLICK[c].dataType for c in ("appId", "funcId", "opDate", "orgCode", "userId")})
    parsed, unreadable = parse.split_valid(parse.parse_json(raw, used, keep=keep), F.lit(True))
    clicks = parsed.select(
        *keep,
        F.col("appId").alias("app_id"),
        F.col("funcId").alias("func_id"),
        F.col("opDate").alias("stropDate"),
        F.col("orgCode").alias("org_code"),
        F.col("userId").alias("user_id"),
    )
    names = enrich.names_left if how == "left" else enrich.names_inner
    named = enrich.org_name(names(clicks, functions, users), orgs)
    columns = named.select(
        *keep,
        F.col("app_id").alias("appId"),
        F.col("func_id").alias("funcId"),
        F.col("func_name").alias("funcName"),
        "stropDate",
        F.col("org_code").alias("orgCode"),
        F.col("org_name").alias("orgName"),
        F.col("user_id").alias("userId"),
        F.col("user_name").alias("userName"),
    )
    return parse.clean_click_json(columns, tz, shift, keep=keep), unreadable


def click_report(
    clicks: DataFrame,
    functions: Dimension,
    orgs: Dimension,
    size: int,
    slide: int,
    unit: str,
    texts: Mapping[str, Callable[[Column], Column]],
) -> DataFrame:
    """PV and UV per application, function, organisation and time unit in hopping windows, with names.

    Names depend on the ids alone and time texts on the unit's start, so the windows are computed
    over ids and the start, and names and texts are made for the result rows: shorter keys in the
    shuffles, fewer lookups.
    """
    timed = clicks.withColumn("__unit", F.date_trunc(unit, "ts"))
    report = windows.hop_pv_uv(timed, [*ID_KEYS, "__unit"], size, slide)
    named = enrich.org_name(lookup(report, functions), orgs)
    return named.withColumns({name: text(local_text("__unit")) for name, text in texts.items()}).drop("__unit")


def connect_intents(raw: DataFrame, orgs: Dimension, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Flat intents with their organisation, strict on the department of both images."""
    schema = schemas.FLAT_CHANGE
    parsed = parse.parse_json(raw, schema, keep=keep)
    images = parsed.withColumns({"__dept": F.col("strdeptcode"), "__old_dept": F.col("beforeRecord.strdeptcode")})
    joined = lookup(lookup(images, orgs, "__dept"), _prefixed(orgs, "old_"), "__old_dept")
    known = F.coalesce(F.col("n_attrs") >= len(ORG_MEMBERS), F.lit(False))
    old_known = F.col("__old_dept").isNull() | F.coalesce(F.col("old_n_attrs") >= len(ORG_MEMBERS), F.lit(False))
    good, bad = parse.split_valid(joined, known & old_known)
    plain = [c for c in schemas.FLAT_INTENT.names if c not in (*ORG_MEMBERS.values(), "deptname")]
    before = F.when(
        F.col("beforeRecord").isNotNull(),
        F.struct(*[F.col(f"beforeRecord.{c}").alias(c) for c in plain], *_org_members("old_")),
    )
    members = [*[F.col(c) for c in plain], *_org_members(), before.alias("beforeRecord")]
    return parse.to_json_value(good, members, keep), bad.select(*parsed.columns)


def _prefixed(orgs: Dimension, prefix: str) -> Dimension:
    frame = orgs.frame.select(*orgs.on, *[F.col(c).alias(f"{prefix}{c}") for c in orgs.attributes])
    return Dimension(frame, orgs.on, orgs.small)


def connect_changes(
    raw: DataFrame, orgs: Dimension, table: str, tz: str = "UTC", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Change records of one table with organisations (default bucket) and loan dates in epoch ms.

    A record that names no table is set aside; one of another table is not this job's.
    """
    parsed, unreadable = parse.split_valid(cdc.parse_change(raw, keep=keep), F.lit(True))
    unnamed = parsed.where(F.col("tableName").isNull()).withColumn(parse.CORRUPT, F.lit(None).cast("string"))
    parsed = cdc.filter_table(parsed, table).withColumn(parse.CORRUPT, F.lit(None).cast("string"))
    dated = parsed.withColumns(
        {
            "dept_code": F.col("strdeptcode.value"),
            "old_dept_code": F.col("beforeRecord.strdeptcode.value"),
            "__ms": epoch_ms("strloandate.value", tz),
            "__old_ms": epoch_ms("beforeRecord.strloandate.value", tz, null_is_zero=False),
        }
    )
    joined = enrich.before_after(dated, orgs)
    readable = F.col("__ms").isNotNull() & (F.col("old_dept_code").isNull() | F.col("__old_ms").isNotNull())
    good, bad = parse.split_valid(joined, readable)
    cells = [c for c in schemas.CDC_COLUMNS if c != "strloandate"]
    before = F.when(
        F.col("beforeRecord").isNotNull(),
        F.struct(
            *[F.col(f"beforeRecord.{c}").alias(c) for c in cells],
            F.when(F.col("old_dept_code").isNotNull(), F.col("__old_ms")).alias("strloandate"),
            *_org_members("old_"),
        ),
    )
    members = [
        F.col("tableName"),
        F.col("opFlag"),
        *[F.col(c) for c in cells],
        F.col("__ms").alias("strloandate"),
        *_org_members(),
        before.alias("beforeRecord"),
    ]
    return parse.to_json_value(good, members, keep), bad.select(*parsed.columns).unionByName(unnamed).unionByName(unreadable)


REPORT_ATTRIBUTES = (*ORG_MEMBERS, "fund_code")


def delta_report(texts: DataFrame, day: str, tz: str = "UTC") -> tuple[DataFrame, DataFrame]:
    """Enriched change texts to the day's totals per department, and the unreadable texts.

    Counts inserts and relevant updates in counted states; an update is corrected by its before image. The ten columns
    of the report: day, department and its name, areas, fund as last seen, count, amount, distinct users.
    """
    rows, unreadable = parse.split_valid(cdc.unwrap_enriched(texts), F.lit(True))
    relevant = rows.where(cdc.relevant_change(day, tz) & cdc.counted_state() & F.col("op_flag").isin("I", "U"))
    dated = relevant.withColumn("day", epoch_to_text("event_ms", "yyyy-MM-dd", tz))
    keys = ("day", "dept_code")
    report = totals.running_delta(dated, keys)
    return totals.with_last_seen(report, dated, keys, REPORT_ATTRIBUTES, ("event_ms", "intent_id")), unreadable


def dept_report(texts: DataFrame, seconds: int = 10, tz: str = "UTC") -> tuple[DataFrame, DataFrame]:
    """Flat intent texts to tumbling reports per department with all attributes, and the rows without text or date.

    Windows follow the loan date; a record without one (0) is set aside before the window.
    """
    rows, bad = parse.split_valid(parse.parse_intent(texts), parse.valid_event_time())
    timed = rows.withColumn("ts", F.timestamp_millis("event_ms").cast("timestamp_ntz"))
    return windows.tumble_report(timed, list(REPORT_ATTRIBUTES), seconds, tie="user_id"), bad


def flatten_changes(
    raw: DataFrame, orgs: Dimension, tz: str = "UTC", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Change records as signed flat records, each with its own department's organisation.

    A record without a before image gives the current row alone.
    """
    parsed, unreadable = parse.split_valid(cdc.parse_change(raw, keep=keep), F.lit(True))
    pairs = cdc.signed_pair(parsed, keep)
    pairs = pairs.withColumn("event_ms", epoch_ms("loan_date", tz, empty_is_zero=False, null_is_zero=False))
    known, missed = enrich.org_strict(pairs, orgs)
    good = known.where("event_ms is not null")
    members = {
        "fund_code": "fundcode",
        "dept_code": "deptcode",
        "loan_date": "loandate",
        "image": "dataOPFlag",
        "dept_name": "detpname",
        "user_id": "user_id",
        "busi_area_code": "busiAreaCode",
        "state": "nstate",
        "intent_id": "intent_id",
        "admin_area_code": "adminAreaCode",
        "admin_area_name": "adminAreaName",
        "busi_area_name": "busiAreaName",
        "amount": "lamount",
        "event_ms": "eventtime",
    }
    texts = parse.to_json_value(good, [F.col(c).alias(m) for c, m in members.items()], keep)
    bad = missed.unionByName(known.where("event_ms is null").select(*missed.columns))
    return texts, bad.unionByName(unreadable.select(*keep, parse.CORRUPT), allowMissingColumns=True)


def table_intents(raw: DataFrame, orgs: Dimension, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Change records as flat table rows; organisation attributes as far as the dimension has them."""
    rows = cdc.unwrap(cdc.parse_change(raw, keep=keep), keep)
    good, unreadable = parse.split_valid(rows, F.lit(True))
    known, missed = enrich.org_strict(good, orgs, attributes=1)
    members = {
        "dept_code": "deptcode",
        "intent_id": "intentID",
        "fund_code": "nborrowmode",
        "loan_date": "strloandate",
        "state": "nstate",
        "amount": "lamount",
        "user_id": "userid",
        "dept_name": "deptname",
        "busi_area_code": "busiAreaCode",
        "busi_area_name": "busiAreaName",
        "admin_area_code": "adminAreaCode",
        "admin_area_name": "adminAreaName",
    }
    typed = known.withColumns({"intent_id": F.col("intent_id").cast("string"), "user_id": F.expr("try_cast(user_id as bigint)")})
    texts = parse.to_json_value(typed, [F.col(c).alias(m) for c, m in members.items()], keep)
    return texts, missed.unionByName(unreadable, allowMissingColumns=True)


def clean_items(raw: DataFrame, areas: Dimension, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Nested records as one text per item, with the record's time and its country's area."""
    parsed, unreadable = parse.split_valid(parse.parse_json(raw, schemas.NESTED_ITEMS, keep=keep), F.lit(True))
    items = enrich.area_of_items(parsed, areas, keep)
    return parse.to_json_value(items, ["type", "score", "level", "area", "dt"], keep), unreadable
