"""Change-data-capture records: unwrap, before images, signed pairs, filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.functions import epoch_to_text
from eventmart.operators.parse import CORRUPT, parse_json

COUNTED_STATES = (4, 5, 7, 9)
SETTLED_STATE = 9

NAMES = {
    "lid": "intent_id",
    "strloandate": "loan_date",
    "nborrowmode": "fund_code",
    "lamount": "amount",
    "nstate": "state",
    "strdeptcode": "dept_code",
    "lborrowerid": "user_id",
}


def parse_change(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    return parse_json(df, schemas.CDC_RECORD, value, keep)


def unwrap(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`{value, isupdate}` cells of the current image as plain columns plus change flags."""
    return parsed.select(
        *keep,
        F.col("tableName").alias("table_name"),
        F.col("opFlag").alias("op_flag"),
        *[F.col(f"{field}.value").alias(name) for field, name in NAMES.items()],
        *[
            F.coalesce(F.col(f"{field}.isupdate"), F.lit(False)).alias(f"{NAMES[field]}_changed")
            for field in ("nstate", "lamount", "nborrowmode")
        ],
        *[c for c in (CORRUPT,) if c in parsed.columns],
    )


def unwrap_enriched(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Enriched change texts as typed rows: both images, change flags and the organisation of the current one."""
    parsed = parse_json(df, schemas.ENRICHED_CHANGE, value, keep)
    cells = {c: n for c, n in NAMES.items() if c != "strloandate"}
    return parsed.select(
        *keep,
        F.col("tableName").alias("table_name"),
        F.col("opFlag").alias("op_flag"),
        F.col("strloandate").alias("event_ms"),
        *[F.col(f"{field}.value").alias(name) for field, name in cells.items()],
        *[
            F.coalesce(F.col(f"{field}.isupdate"), F.lit(False)).alias(f"{NAMES[field]}_changed")
            for field in ("nstate", "lamount", "nborrowmode")
        ],
        F.col("detpname").alias("dept_name"),
        F.col("busiAreaCode").alias("busi_area_code"),
        F.col("busiAreaName").alias("busi_area_name"),
        F.col("adminAreaCode").alias("admin_area_code"),
        F.col("adminAreaName").alias("admin_area_name"),
        F.col("beforeRecord.strloandate").alias("old_event_ms"),
        *[F.col(f"beforeRecord.{field}.value").alias(f"old_{name}") for field, name in cells.items()],
        CORRUPT,
    )


def unwrap_before(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cells of the before image as `old_*` columns, null where a record has none."""
    return parsed.select(
        *keep,
        F.col("beforeRecord").isNotNull().alias("has_before"),
        *[F.col(f"beforeRecord.{field}.value").alias(f"old_{name}") for field, name in NAMES.items()],
    )


def signed_pair(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A `current` row, and for a record with a before image also a `before` row with negated amount.

    Both rows come out of one pass over the record; nothing is shuffled.
    """

    def image(path: str, tag: str, sign: int) -> Column:
        cells = [
            ((sign * F.col(f"{path}{field}.value")) if field == "lamount" else F.col(f"{path}{field}.value")).alias(name)
            for field, name in NAMES.items()
        ]
        return F.struct(*cells, F.lit(tag).alias("image"))

    before = F.when(F.col("beforeRecord").isNotNull(), image("beforeRecord.", "before", -1))
    return parsed.select(*keep, F.inline(F.array_compact(F.array(image("", "current", 1), before))))


def filter_table(parsed: DataFrame, table: str, column: str = "tableName") -> DataFrame:
    return parsed.where(F.col(column) == table)


def counted_state(column: str = "state", states: Sequence[int] = COUNTED_STATES) -> Column:
    return F.col(column).isin(*states)


def relevant_change(day: str, tz: str = "UTC", event_ms: str = "event_ms") -> Column:
    """An insert, or a change of state, amount or fund, of a loan dated on the given day."""
    changed = F.col("state_changed") | F.col("amount_changed") | F.col("fund_code_changed")
    return (epoch_to_text(event_ms, "yyyy-MM-dd", tz) == day) & (changed | (F.col("op_flag") == "I"))
