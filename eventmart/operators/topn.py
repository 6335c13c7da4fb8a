"""Top-N per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.operators.windows import hop_count


def top_n(counts: DataFrame, n: int = 5, key: str = "func_id", window: str = "window_end") -> DataFrame:
    """The `n` largest counts per window, ranked from 1, equal counts in key order.

    A filter on row_number is applied before the shuffle too, so each task sends at most `n` rows
    per window.
    """
    order = Window.partitionBy(window).orderBy(F.desc("cnt"), key)
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hot_functions(clicks: DataFrame, n: int = 5, size: int = 60, slide: int = 5) -> DataFrame:
    return top_n(hop_count(clicks, ["func_id"], size, slide), n)


# The wording of the ranking report, up to the rank, after it, and between entries.
HEAD, RANK, FUNCTION, VIEWS = "时间：", "第", "名功能 ", " pv="
RULE = "========================================"


def ranking_text(ranked: DataFrame, window: str = "window_end") -> DataFrame:
    """One text per window from its ranked rows: a head line, then an entry and a rule per rank."""
    entry = F.concat(F.lit(RANK), "rank", F.lit(FUNCTION), "func_id", F.lit(VIEWS), "cnt", F.lit(f"\n{RULE}\n"))
    # The input holds at most n rows per window, so the collected list is bounded.
    entries = F.sort_array(F.collect_list(F.struct("rank", entry.alias("entry"))))
    head = F.concat(F.lit(HEAD), F.date_format(window, "yyyy-MM-dd HH:mm:ss.S"), F.lit("\n"))
    return ranked.groupBy(window).agg(entries.alias("entries")).select(
        window, F.concat(head, F.array_join(F.transform("entries", lambda item: item["entry"]), "")).alias("report")
    )
