"""Domain records expressed over the given tables (see FIXTURES.md).

Each view is one SQL text that reads the same in Spark and DuckDB; `{table}` marks an input.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions import day_text, local_text
from eventmart.streaming.files import copies, names

VIEWS: dict[str, str] = {
    "clicks": """
        select event_id, concat('app_', cast(event_id % 3 as string)) as app_id, event_type as func_id,
               cast(user_id as string) as user_id, cast(user_id % 27 as string) as org_code, ts
        from {events}""",
    # A different arrival order: up to 20 minutes of delay, fixed per row.
    "arrivals": """
        select event_id, event_type as func_id, ts,
               ts + (((event_id * 7919) % 1200) * interval '1' second) as arrival
        from {events}""",
    "function_dim": """
        select distinct event_type as func_id, upper(event_type) as func_name
        from {events} where event_type <> 'error'""",
    "user_dim": """
        select cast(c_custkey as string) as user_id, c_name as user_name
        from {customer} where c_custkey % 10 <> 9""",
    "org_raw": """
        select cast(n_nationkey as string) as k,
               case when n_nationkey = 24
                    then concat(n_name, ',B', cast(n_regionkey as string), ',', r_name)
                    else concat(n_name, ',B', cast(n_regionkey as string), ',', r_name,
                                ',A', cast(n_nationkey % 7 as string), ',ADMIN_', cast(n_nationkey % 7 as string))
               end as v
        from {nation} join {region} on n_regionkey = r_regionkey""",
    # A later snapshot: every third code gone, the rest renamed.
    "org_raw_next": """
        select cast(n_nationkey as string) as k,
               concat('NEW_', n_name, ',B', cast(n_regionkey as string), ',', r_name, ',A0,ADMIN_0') as v
        from {nation} join {region} on n_regionkey = r_regionkey where n_nationkey % 3 <> 0""",
    "intents": """
        select o_orderkey as lid, cast(o_custkey % 27 as string) as strdeptcode,
               cast(round(o_totalprice * 100) as bigint) as lamount,
               case o_orderstatus when 'F' then 9 when 'O' then 5 else 32 end as nstate,
               substring(o_orderpriority, 1, 1) as nborrowmode, cast(o_custkey as string) as lborrowerid,
               case o_orderkey % 3 when 0 then 'I' when 1 then 'U' else 'US' end as op_flag,
               case when o_orderkey % 97 = 0 then null
                    else o_orderdate + ((o_orderkey % 86400) * interval '1' second) end as strloandate,
               case when o_orderkey % 11 = 0 then 'other_table' else 'loan_intent' end as table_name,
               o_orderkey % 4 = 0 as nstate_upd, o_orderkey % 5 = 0 as lamount_upd,
               o_orderkey % 7 = 0 as nborrowmode_upd,
               case when o_orderkey % 3 = 1
                    then cast(round(o_totalprice * 100) as bigint) - 100 * (o_orderkey % 1000) end as old_lamount,
               case when o_orderkey % 3 = 1
                    then (case when o_orderkey % 2 = 0 then 4 else 2 end) end as old_nstate,
               case when o_orderkey % 3 = 1 then cast((o_custkey + 1) % 27 as string) end as old_deptcode
        from {orders}""",
    # Events read as flat intents in time order, for the streamed reports.
    "event_intents": """
        select event_id as intent_id, cast(user_id % 27 as string) as dept_code,
               cast(round(value * 100) as bigint) as amount, 9 as state,
               substring(event_type, 1, 1) as fund_code, cast(user_id as string) as user_id,
               case event_type when 'view' then 'U' when 'error' then 'US' else 'I' end as op_flag, ts
        from {events}""",
    "funds": """
        select distinct substring(o_orderpriority, 1, 1) as fund_code,
               case when substring(o_orderpriority, 1, 1) <= '3' then 0 else 1 end as business_type
        from {orders}""",
    "bills": """
        select l_orderkey as intent_id, cast(l_suppkey % 27 as string) as dept_code,
               cast(round(l_extendedprice * 100) as bigint) as principal,
               case l_returnflag when 'R' then 9 when 'A' then 32 else 1 end as state,
               cast(l_linenumber as string) as fund_code,
               cast(l_shipdate as date) as repay_date
        from {lineitem}""",
    "applications": """
        select case when o_orderstatus = 'F' then '2' else '1' end as apply_status,
               cast(round(o_totalprice * 100) as bigint) as amount,
               case when o_orderkey % 97 = 0 then null else cast(o_orderdate as date) end as success_date
        from {orders}""",
    "repayments": """
        select case when l_returnflag = 'R' then '2' else '1' end as repay_status,
               cast(round(l_extendedprice * 100) as bigint) as principal,
               cast(l_shipdate as date) as repay_date
        from {lineitem}""",
    "bad_debts": """
        select cast(l_suppkey % 27 as string) as dept_code, cast(l_shipdate as date) as day,
               cast(round(l_extendedprice * l_tax * 100) as bigint) as bad_debt
        from {lineitem}""",
    # Nested records of two items each; the country is that of the supplier.
    "item_records": """
        select l_orderkey, l_linenumber, l_shipdate as dt, n_name as country,
               l_returnflag as type_1, l_discount as score_1, l_linestatus as level_1,
               l_linestatus as type_2, l_tax as score_2, l_returnflag as level_2
        from {lineitem} join {supplier} on l_suppkey = s_suppkey join {nation} on s_nationkey = n_nationkey""",
}


def sql_of(view: str) -> str:
    """The view's text over plain table names, as DuckDB reads it."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEWS[view])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    inputs = {t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **inputs)


def stream_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over its table read as a stream of files."""
    text = VIEWS[name]
    inputs = {}
    for t in set(re.findall(r"\{(\w+)\}", text)):
        # A pattern, because the file source takes a folder or a pattern, not one file.
        reader = spark.readStream.schema(table(spark, sf_dir, t).schema)
        inputs[t] = reader.parquet(f"{sf_dir}/{t}.parque[t]")
    return spark.sql(text, **inputs)


#: Rows that one task reads and one file of a replayed part holds, about.
FILE_ROWS = 1_000_000


def replayed(rows: DataFrame, part: Column, parts: int, folder: str) -> DataFrame:
    """Rows as a stream that brings those of each part in a micro-batch of its own, in order; texts (`value` alone) as text files.

    The number of files grows with the rows. A micro-batch takes the same number of files each time, so parts of fewer
    files are filled up with empty ones.
    """
    spark = rows.sparkSession
    kind = "text" if rows.columns == ["value"] or set(rows.columns) == {"part", "value"} else "parquet"
    plain = [c for c in rows.columns if c != "part"]
    count = max(1, -(-rows.count() // FILE_ROWS))
    for nth in range(parts):
        target = f"{folder}/{nth:03}"
        rows.where(part == nth).select(*plain).coalesce(count).write.format(kind).save(target)
        there = sum(name.startswith("part-") for name in names(spark, target))
        if there < count:
            spare = f"{folder}-empty/{nth:03}"
            rows.limit(0).select(*plain).coalesce(1).write.format(kind).save(spare)
            empty = next(name for name in names(spark, spare) if name.startswith("part-"))
            copies(spark, f"{spare}/{empty}", [f"{target}/empty-{i:05}-{empty}" for i in range(count - there)])
    reader = spark.readStream.format(kind).schema(rows.select(*plain).schema)
    return reader.option("maxFilesPerTrigger", count).load(f"{folder}/*")


# Decades after all rows: closes every window of a finite input.
CLOSING = "2100-01-01 00:00:00"


def closed_stream(rows: DataFrame, folder: str, days: int = 10, parts: int = 3) -> DataFrame:
    """Timed rows in `parts` micro-batches of some days each, and a closing row, whose own windows stay open."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - 1_704_067_200
    part = F.least(F.lit(parts - 1), F.floor(seconds / (86_400 * days))).cast("int")
    closing = rows.limit(1).withColumn("ts", F.lit(CLOSING).cast(rows.schema["ts"].dataType)).withColumn("part", F.lit(parts))
    return replayed(rows.withColumn("part", part).unionByName(closing), F.col("part"), parts + 1, folder)


def area_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region -> comma list of its nations (25 rows in all)."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    names = F.array_join(F.array_sort(F.collect_list("n_name")), ",")
    return (
        nations.join(regions, nations.n_regionkey == regions.r_regionkey)
        .groupBy(F.col("r_name").alias("k"))
        .agg(names.alias("v"))
    )


def intent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unwrapped intents under the names the operators use."""
    rows = view(spark, sf_dir, "intents")
    return rows.select(
        F.col("lid").alias("intent_id"),
        F.col("strdeptcode").alias("dept_code"),
        F.col("lamount").alias("amount"),
        F.col("nstate").alias("state"),
        F.col("nborrowmode").alias("fund_code"),
        F.col("lborrowerid").alias("user_id"),
        "op_flag",
        F.col("strloandate").alias("ts"),
        day_text(local_text("strloandate")).alias("day"),
        "table_name",
        F.col("nstate_upd").alias("state_changed"),
        F.col("lamount_upd").alias("amount_changed"),
        F.col("nborrowmode_upd").alias("fund_code_changed"),
        F.col("old_lamount").alias("old_amount"),
        F.col("old_nstate").alias("old_state"),
        F.col("old_deptcode").alias("old_dept_code"),
    )


def click_json(clicks: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clicks as raw JSON text. Every 50th record is cut short, every 51st has no time."""
    op_date = F.when(F.col("event_id") % 51 != 0, local_text("ts"))
    text = F.to_json(
        F.struct(
            F.col("app_id").alias("appId"),
            F.col("func_id").alias("funcId"),
            op_date.alias("opDate"),
            F.col("org_code").alias("orgCode"),
            F.lit(True).alias("success"),
            F.col("user_id").alias("userId"),
        )
    )
    return clicks.select(*keep, F.when(F.col("event_id") % 50 == 0, F.substring(text, 1, 20)).otherwise(text).alias("value"))


def flat_intent_json(rows: DataFrame, keep: tuple[str, ...] = (), before: bool = False) -> DataFrame:
    """Intents as flat JSON text, with the loan date in epoch milliseconds (0 where there is none)."""
    old = F.struct(
        F.col("old_dept_code").alias("strdeptcode"),
        F.col("old_amount").alias("lamount"),
        F.col("old_state").alias("nstate"),
    )
    image = [F.when(F.col("old_dept_code").isNotNull(), old).alias("beforeRecord")] if before else []
    ms = F.coalesce(F.unix_millis(F.col("ts").cast("timestamp")), F.lit(0))
    return rows.select(
        *keep,
        F.to_json(
            F.struct(
                F.col("fund_code").alias("nborrowmode"),
                F.col("dept_code").alias("strdeptcode"),
                F.col("state").alias("nstate"),
                ms.alias("strloandate"),
                F.col("user_id").alias("userid"),
                F.col("amount").alias("lamount"),
                F.col("op_flag").alias("opFlag"),
                F.concat(F.lit("dept "), F.col("dept_code")).alias("detpname"),
                *image,
            )
        ).alias("value"),
    )


def cdc_json(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Intents as enveloped change records, with a before image for updates."""

    def cell(value, changed=None):
        return F.struct(value.alias("value"), (F.lit(False) if changed is None else F.col(changed)).alias("isupdate"))

    date = local_text("ts")

    def image(amount: str, state: str, dept: str, flags: bool):
        return [
            cell(F.col("intent_id")).alias("lid"),
            cell(date).alias("strloandate"),
            cell(F.col("fund_code"), "fund_code_changed" if flags else None).alias("nborrowmode"),
            cell(F.col(amount), "amount_changed" if flags else None).alias("lamount"),
            cell(F.col(state), "state_changed" if flags else None).alias("nstate"),
            cell(F.col(dept)).alias("strdeptcode"),
            cell(F.col("user_id")).alias("lborrowerid"),
        ]

    before = F.when(F.col("op_flag") == "U", F.struct(*image("old_amount", "old_state", "old_dept_code", False)))
    return rows.select(
        *keep,
        F.to_json(
            F.struct(
                F.col("table_name").alias("tableName"),
                F.col("op_flag").alias("opFlag"),
                *image("amount", "state", "dept_code", True),
                before.alias("beforeRecord"),
            )
        ).alias("value"),
    )


def item_json(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    items = F.array(
        *[
            F.struct(
                F.col(f"type_{i}").alias("type"), F.col(f"score_{i}").alias("score"), F.col(f"level_{i}").alias("level")
            )
            for i in (1, 2)
        ]
    )
    body = F.struct(local_text("dt").alias("dt"), F.col("country").alias("countryCode"), items.alias("data"))
    return records.select(*keep, F.to_json(body).alias("value"))
