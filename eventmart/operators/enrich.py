"""Enrichment of clicks and intents with names from dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators.lookup import Dimension, lookup
from eventmart.operators.parse import explode_items
from eventmart.sources.dims import ORG_COLUMNS

# The bucket for departments the organisation dimension does not know.
OTHER_ORG = {
    "dept_name": "其他营业部",
    "busi_area_code": "9527404",
    "busi_area_name": "其他中心",
    "admin_area_code": "9527404",
    "admin_area_name": "其他区域",
}


def names_left(clicks: DataFrame, functions: Dimension, users: Dimension) -> DataFrame:
    """Function and user names; a missing key gives a null name."""
    return lookup(lookup(clicks, functions, how="left"), users, how="left")


def names_inner(clicks: DataFrame, functions: Dimension, users: Dimension) -> DataFrame:
    """Function and user names; a row with a missing key is dropped."""
    return lookup(lookup(clicks, functions, how="inner"), users, how="inner")


def org_name(clicks: DataFrame, orgs: Dimension, name: str = "org_name") -> DataFrame:
    """Organisation name only; empty text for an unknown code."""
    slim = Dimension(orgs.frame.select(*orgs.on, F.col("dept_name").alias("__name")), orgs.on, orgs.small)
    joined = lookup(clicks.drop(name), slim, how="left")
    return joined.withColumn(name, F.coalesce("__name", F.lit(""))).drop("__name")


def org_fail_open(clicks: DataFrame, orgs: Dimension, available: bool, name: str = "org_name") -> DataFrame:
    """As `org_name` while the store answers; otherwise rows pass through as they came."""
    return org_name(clicks, orgs, name) if available else clicks


def org_strict(
    intents: DataFrame, orgs: Dimension, dept: str = "dept_code", attributes: int = len(ORG_COLUMNS)
) -> tuple[DataFrame, DataFrame]:
    """Rows whose department is known with all attributes, and the others for quarantine."""
    joined = lookup(intents, orgs, dept, how="left")
    known = F.coalesce(F.col("n_attrs") >= attributes, F.lit(False))
    return (
        joined.where(known).drop("n_attrs"),
        joined.where(~known).drop("n_attrs", *orgs.attributes),
    )


def _with_default(orgs: Dimension) -> Dimension:
    full = orgs.frame.where(F.col("n_attrs") == len(ORG_COLUMNS)).drop("n_attrs")
    return Dimension(full, orgs.on, orgs.small)


def org_default(
    intents: DataFrame,
    orgs: Dimension,
    dept: str = "dept_code",
    prefix: str = "",
    default: Mapping[str, str] = OTHER_ORG,
    only_if: Column | None = None,
) -> DataFrame:
    """Organisation attributes; an unknown code, or one without all attributes, goes to the default bucket.

    With `only_if`, rows it does not hold for get nulls instead of the bucket.
    """
    full = _with_default(orgs)
    renamed = full.frame.select(*full.on, *[F.col(c).alias(f"{prefix}{c}") for c in ORG_COLUMNS])
    joined = lookup(intents, Dimension(renamed, full.on, full.small), dept, how="left")
    filled = {}
    for column in ORG_COLUMNS:
        value = F.coalesce(F.col(f"{prefix}{column}"), F.lit(default[column]))
        filled[f"{prefix}{column}"] = value if only_if is None else F.when(only_if, value)
    return joined.withColumns(filled)


def before_after(intents: DataFrame, orgs: Dimension) -> DataFrame:
    """The organisation of the current and, where there is one, of the before image."""
    current = org_default(intents, orgs)
    return org_default(current, orgs, "old_dept_code", "old_", only_if=F.col("old_dept_code").isNotNull())


def area_of_items(records: DataFrame, areas: Dimension, keep: Sequence[str] = ()) -> DataFrame:
    """Nested items with the area of their country (null if unknown) and the record's time.

    The lookup comes before the explode, so it runs once per record.
    """
    return explode_items(lookup(records, areas, "countryCode"), [*keep, "dt", "countryCode", "area"])

