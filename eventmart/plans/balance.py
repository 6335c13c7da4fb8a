"""Daily balance and bad-debt report per department.

Every branch is aggregated before it meets another one, so the joins and unions of the report proper
work on one row per department. The report day is a parameter: the same inputs give the same report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators.lookup import Dimension, dimension, lookup

# Loan states that count, and states of a bill that is repaid or turned into instalments.
LENT_STATES = (4, 5, 7, 9, 32)
REPAID, INSTALMENT = 9, 32
OTHER_DEPT = "04xxxxxxx"


@dataclass(frozen=True)
class BalanceInputs:
    applications: DataFrame
    repayments: DataFrame
    funds: DataFrame
    intents: DataFrame
    bills: DataFrame
    bad_debts: DataFrame
    orgs: DataFrame


def _zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("bigint"))


def _day(day: str) -> Column:
    return F.lit(day).cast("date")


def balance_global(inputs: BalanceInputs, day: str, bucket: str = OTHER_DEPT) -> DataFrame:
    """All accepted amounts less all repaid principals before the day, booked on the default bucket."""
    lent = inputs.applications.where(
        (F.col("apply_status") == "2") & (F.col("amount") >= 0) & (F.col("success_date") < _day(day))
    ).agg(_zero(F.sum("amount")).alias("borrowed"), F.lit(0).cast("bigint").alias("repaid"))
    repaid = inputs.repayments.where((F.col("repay_status") == "2") & (F.col("repay_date") < _day(day))).agg(
        F.lit(0).cast("bigint").alias("borrowed"), _zero(F.sum("principal")).alias("repaid")
    )
    total = lent.unionByName(repaid).agg(_zero(F.sum("borrowed") - F.sum("repaid")).alias("balance_1"))
    return total.select(F.lit(bucket).alias("dept_code"), "balance_1")


def own_funds(inputs: BalanceInputs) -> Dimension:
    return dimension(inputs.funds.where("business_type = 0").select("fund_code"), "fund_code")


def balance_repaid(inputs: BalanceInputs, day: str, staged: Sequence[str], funds: Dimension | None = None) -> DataFrame:
    """Repaid principal per department, by kind, for loans of own funds.

    Bills and intents both grow with the data: a shuffled join on the intent, each side filtered and
    cut to three narrow columns first. Adaptive execution splits an intent with very many bills.
    """
    loans = inputs.intents.where(F.col("state").isin(*LENT_STATES)).select("intent_id", "fund_code")
    loans = lookup(loans, funds or own_funds(inputs), how="inner").select("intent_id")
    bills = inputs.bills.where(
        F.col("state").isin(REPAID, INSTALMENT) & (F.col("principal") > 0) & (F.col("repay_date") < _day(day))
    )
    staged_bill = F.col("fund_code").isin(*staged)

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("principal")).otherwise(0))

    return (
        bills.join(loans, "intent_id")
        .groupBy("dept_code")
        .agg(
            total(~staged_bill & (F.col("state") == REPAID)).alias("repaid_plain"),
            total(staged_bill & (F.col("state") == REPAID)).alias("repaid_staged"),
            total(F.col("state") == INSTALMENT).alias("instalments"),
        )
    )


def balance_lent(inputs: BalanceInputs, day: str, staged: Sequence[str], funds: Dimension | None = None) -> DataFrame:
    """Lent amount per department, by kind, for loans of own funds dated before the day."""
    loans = inputs.intents.where(
        F.col("ts").isNotNull()
        & (F.to_date("ts") < _day(day))
        & F.col("state").isin(*LENT_STATES)
        & (F.col("amount") > 0)
    )
    staged_loan = F.col("fund_code").isin(*staged)
    return (
        lookup(loans.select("dept_code", "fund_code", "amount"), funds or own_funds(inputs), how="inner")
        .groupBy("dept_code")
        .agg(
            _zero(F.sum(F.when(~staged_loan, F.col("amount")))).alias("lent_plain"),
            _zero(F.sum(F.when(staged_loan, F.col("amount")))).alias("lent_staged"),
        )
    )


def balance_by_dept(inputs: BalanceInputs, day: str, staged: Sequence[str]) -> DataFrame:
    """Lent less repaid less turned into instalments, per department."""
    funds = own_funds(inputs)
    zero = F.lit(0).cast("bigint")
    repaid = balance_repaid(inputs, day, staged, funds).select(
        "dept_code", zero.alias("lent"), (F.col("repaid_plain") + F.col("repaid_staged")).alias("repaid"), "instalments"
    )
    lent = balance_lent(inputs, day, staged, funds).select(
        "dept_code",
        (F.col("lent_plain") + F.col("lent_staged")).alias("lent"),
        zero.alias("repaid"),
        zero.alias("instalments"),
    )
    balance = F.sum(_zero(F.col("lent")) - _zero(F.col("repaid")) - _zero(F.col("instalments")))
    return repaid.unionByName(lent).groupBy("dept_code").agg(_zero(balance).alias("balance_2"))


def day_over_day(inputs: BalanceInputs, day: str) -> DataFrame:
    """Bad debt of the day before less that of two days before, for every department on record."""

    def on(days_back: int) -> Column:
        return _zero(F.sum(F.when(F.col("day") == F.date_sub(_day(day), days_back), F.col("bad_debt"))))

    return inputs.bad_debts.groupBy("dept_code").agg((on(1) - on(2)).alias("bad_debt_change"))


def balance_report(
    inputs: BalanceInputs,
    day: str,
    staged: Sequence[str],
    bucket: str = OTHER_DEPT,
    distribute_by: Sequence[str] = (),
) -> DataFrame:
    """All branches per department known to the organisation dimension; the rest in one bucket."""
    zero = F.lit(0).cast("bigint")
    branches = (
        balance_global(inputs, day, bucket)
        .unionByName(balance_by_dept(inputs, day, staged), allowMissingColumns=True)
        .unionByName(day_over_day(inputs, day), allowMissingColumns=True)
        .na.fill(0)
    )
    orgs = dimension(inputs.orgs.select(F.col("org_code"), F.col("org_code").alias("known_code")), "org_code")
    known = lookup(branches, orgs, "dept_code", how="left")
    report = (
        known.groupBy(F.coalesce("known_code", F.lit(bucket)).alias("dept"))
        .agg(
            (F.coalesce(F.sum("balance_1"), zero) * 100).alias("balance_1"),
            F.coalesce(F.sum("balance_2"), zero).alias("balance_2"),
            F.coalesce(F.sum("bad_debt_change"), zero).alias("bad_debt_change"),
        )
        .withColumn("strdate", F.date_sub(_day(day), 1).cast("string"))
    )
    return report.repartition(*distribute_by) if distribute_by else report
