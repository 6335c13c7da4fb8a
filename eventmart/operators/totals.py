"""Running totals per department, and exact distinct users."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators.cdc import COUNTED_STATES, counted_state


def sign_of_operation(op_flag: str = "op_flag") -> Column:
    """+1 for insert and update, -1 for the subtracting half of an update, 0 for anything else."""
    flag = F.col(op_flag)
    return F.when(flag.isin("I", "U"), 1).when(flag == "US", -1).otherwise(0)


def unknown_operation(op_flag: str = "op_flag", known: Sequence[str] = ("I", "U", "US")) -> Column:
    return F.coalesce(~F.col(op_flag).isin(*known), F.lit(True))


def signed_amount(op_flag: str = "op_flag", amount: str = "amount") -> Column:
    return sign_of_operation(op_flag) * F.col(amount)


def delta_amount(op_flag: str = "op_flag", amount: str = "amount") -> Column:
    """Insert: the amount. Update: the amount less the old one, where the old state counted."""
    old = F.when(counted_state("old_state", COUNTED_STATES), F.col("old_amount")).otherwise(0)
    flag = F.col(op_flag)
    return F.when(flag == "I", F.col(amount)).when(flag == "U", F.col(amount) - F.coalesce(old, F.lit(0))).otherwise(0)


def delta_count(op_flag: str = "op_flag") -> Column:
    return F.when(F.col(op_flag).isin("I", "U"), 1).otherwise(0)


def totals(rows: DataFrame, keys: Sequence[str], count: Column, amount: Column, user: str = "user_id") -> DataFrame:
    """Sums of the two step columns and exact distinct users per key.

    Combined per (key, user) first: the wide shuffle is spread by user, so a department holding a
    large share of the rows does not end in one task, and the second step only adds user rows up.
    """
    per_user = rows.groupBy(*keys, user).agg(F.sum(count).alias("c"), F.sum(amount).alias("a"))
    return per_user.groupBy(*keys).agg(
        F.sum("c").alias("lend_cnt"), F.sum("a").alias("lend_amount"), F.count(user).alias("user_cnt")
    )


def running_totals(rows: DataFrame, keys: Sequence[str] = ("day", "dept_code")) -> DataFrame:
    """Rows with an unknown operation are left out; `unknown_operation` selects them for quarantine."""
    return totals(rows.where(~unknown_operation()), keys, sign_of_operation(), signed_amount())


def running_delta(rows: DataFrame, keys: Sequence[str] = ("day", "dept_code")) -> DataFrame:
    """As `running_totals`, with updates corrected by their before image; knows inserts and updates only."""
    return totals(rows.where(~unknown_operation(known=("I", "U"))), keys, delta_count(), delta_amount())


def with_last_seen(
    report: DataFrame, rows: DataFrame, keys: Sequence[str], attributes: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The report with each key's attributes as last seen: those of the greatest `order` among its rows.

    Rows are combined per key before the shuffle, as in every report.
    """
    last = rows.groupBy(*keys).agg(F.max(F.struct(*order, *attributes)).alias("__last"))
    names = [f"__key_{i}" for i in range(len(keys))]
    last = last.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[F.col(f"__last.{a}").alias(a) for a in attributes])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return report.join(last, same).drop(*names)


def net_totals(pairs: DataFrame, keys: Sequence[str] = ("day", "dept_code")) -> DataFrame:
    """Totals over signed pairs: a before image leaves the department it names."""
    step = F.when(F.col("image") == "before", -1).otherwise(1)
    return totals(pairs, keys, step, F.col("amount"))


def distinct_users(
    rows: DataFrame, keys: Sequence[str] = ("dept_code",), user: str = "user_id", approximate: bool = False
) -> DataFrame:
    count = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    return rows.groupBy(*keys).agg(count.alias("user_cnt"))
