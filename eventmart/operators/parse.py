"""JSON text to typed rows and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.functions import iso_utc

CORRUPT = "_corrupt_record"


def _as_text(kind: T.DataType) -> T.DataType:
    """The layout with every scalar as text: the parser then takes numbers in quotes and numbers without alike."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return T.StringType()


def _whole(text: Column, kind: T.DataType) -> Column:
    """A whole number written as such, or as a decimal or power of ten without a fraction (`500.0`, `1e3`).

    A cast that fails costs an exception inside Spark, many times a parse; texts that hold a letter or sign that no such number has
    are not cast.
    """
    exact = F.when(~text.rlike("[A-DF-Za-df-z/]"), text.try_cast(T.DecimalType(38, 10)))
    return F.coalesce(F.when(~text.rlike("[.A-Za-z/]"), text.try_cast(kind)), F.when(exact == F.floor(exact), exact.try_cast(kind)))


def _typed(column: Column, kind: T.DataType) -> Column:
    """Text scalars as what the layout says; null where that cannot be."""
    if isinstance(kind, T.StructType):
        members = [_typed(column[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*members))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _typed(x, kind.elementType))
    if isinstance(kind, T.IntegralType):
        return _whole(column, kind)
    return column if isinstance(kind, T.StringType) else column.try_cast(kind)


def _unreadable(column: Column, kind: T.DataType) -> Column:
    """Whether a scalar stands there, is not blank, and cannot be what the layout says."""
    if isinstance(kind, T.StructType):
        return reduce(or_, (_unreadable(column[f.name], f.dataType) for f in kind.fields), F.lit(False))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(column, lambda x: _unreadable(x, kind.elementType)), F.lit(False))
    if isinstance(kind, T.StringType):
        return F.lit(False)
    return F.coalesce((F.trim(column) != "") & _typed(column, kind).isNull(), F.lit(False))


def parse_json(
    df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Tolerant parse: unreadable text leaves nulls and its own copy in `_corrupt_record`.

    A null or blank text is unreadable too; of a null its copy is an empty text. Numbers may stand in quotes, and whole numbers
    may be written as decimals or powers of ten without a fraction. A record with a number that is there and cannot be read is
    unreadable: it is set aside rather than counted without its amount. Its other members are given all the same.
    """
    # Members become columns through a generator. As a projection the parse would be copied into
    # every filter on a member that the optimizer moves below it, and run once per copy.
    names, corrupt = schema.names, T.StructField(CORRUPT, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def parsed(text: str, layout: T.StructType) -> Column:
        record = F.from_json(F.col(text), T.StructType([*layout.fields, corrupt]), options)
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in layout.fields]
        return F.coalesce(record, F.struct(*nothing, F.coalesce(F.col(text), F.lit("")).alias(CORRUPT)))

    def read_text(record: Column) -> Column:
        """A record of text scalars, as typed ones."""
        bad = F.when(_unreadable(record, schema), F.col("__text"))
        members = [_typed(record[f.name], f.dataType).alias(f.name) for f in schema.fields]
        return F.struct(*members, F.coalesce(record[CORRUPT], bad).alias(CORRUPT))

    # Most records are read as the layout says, at once. Only those that are not are parsed again, with every scalar as text.
    quick = df.select(*keep, F.col(value).alias("__text"), F.inline(F.array(parsed(value, schema))))
    as_is = F.struct(*(F.col(name) for name in names), F.col(CORRUPT))
    again = F.transform(F.array(parsed("__text", _as_text(schema))), read_text)
    return quick.select(*keep, F.inline(F.when(F.col(CORRUPT).isNull(), F.array(as_is)).otherwise(again)))


def parse_json_strict(
    df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Strict parse: unreadable text or an absent field stops the query. A null member is not absent."""
    record = F.from_json(F.col(value), schema, {"mode": "FAILFAST"})
    absent = F.array_except(F.array(*[F.lit(f.name) for f in schema.fields]), F.json_object_keys(F.col(value)))
    checked = F.when(F.size(absent) == 0, record).otherwise(
        F.raise_error(F.concat(F.lit("missing fields: "), F.concat_ws(",", absent)))
    )
    return df.select(*keep, F.inline(F.array(checked)))


def split_valid(parsed: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows fit for the next step, and the rest for quarantine (nothing is lost)."""
    ok = F.col(CORRUPT).isNull() & F.coalesce(valid, F.lit(False))
    return parsed.where(ok).drop(CORRUPT), parsed.where(~ok)


def to_json_value(df: DataFrame, columns: Sequence[str | Column], keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row in `value`: members in the given order, null members left out."""
    return df.select(*keep, F.to_json(F.struct(*columns)).alias("value"))


def clean_click_json(df: DataFrame, tz: str = "UTC", shift: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Enriched clicks as the JSON text of the clean topic.

    An unreadable time only loses the `logoptime` member.
    """
    columns = [F.col(c) for c in schemas.CLEAN_CLICK.names if c != "logoptime"]
    return to_json_value(df, [*columns, iso_utc("stropDate", tz, shift).alias("logoptime")], keep)


def parse_intent(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Flat loan-intent records as typed report rows."""
    parsed = parse_json(df, schemas.FLAT_INTENT, value, keep)
    return parsed.select(
        *keep,
        F.col("strloandate").alias("event_ms"),
        F.col("strdeptcode").alias("dept_code"),
        F.coalesce("detpname", "deptname").alias("dept_name"),
        F.col("busiAreaCode").alias("busi_area_code"),
        F.col("busiAreaName").alias("busi_area_name"),
        F.col("adminAreaCode").alias("admin_area_code"),
        F.col("adminAreaName").alias("admin_area_name"),
        F.col("nborrowmode").alias("fund_code"),
        F.col("lamount").alias("amount"),
        F.col("userid").alias("user_id"),
        F.col("nstate").alias("state"),
        F.col("opFlag").alias("op_flag"),
        CORRUPT,
    )


def valid_event_time(column: str = "event_ms", allow_zero: bool = False) -> Column:
    """0 marks a record without a loan date; one report family keeps it, the others drop it."""
    return F.col(column) >= 0 if allow_zero else F.col(column) != 0


def explode_items(df: DataFrame, parents: Sequence[str], items: str = "data") -> DataFrame:
    """One row per element of a nested array, with the parent's columns copied to each."""
    return df.select(*parents, F.inline(F.col(items)))
