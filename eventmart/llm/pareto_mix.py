"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source gets a target in words. A document's expected number of copies is its source's target over its source's
words, times its importance where one is given. The whole part is certain. The fraction is an inclusion
probability p: documents are ranked by ((u / (1 - u)) / (p / (1 - p))), u being random in (0, 1), and taken from the
smallest rank on until the source's remaining words are filled. u comes from the document's id, or from the key that is
given, so that reruns agree.

A running sum over the ranks of a source that holds a third of all rows would be one task. The ranks are therefore cut
into `SLICES` slices per source; sizes are summed per slice, the running sum goes over the slices, and only
the one slice of each source in which the target is reached is ordered document by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import BLANKS, WORD

WEIGHTS = (3, 1, 2)
SLICES = 4096


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> the same with `target` words: `share` of all words by weight, at most `most` times the source.

    Sources in code point order, null last, take the weights in turn. What a full source leaves is shared anew by weight
    until none is above: all open sources then stand at one level L of words per weight, and a source is full
    exactly if its most words per weight do not exceed L. In the order of most / weight, L is the budget left by the full
    ones over the weight left. One row per source goes through one task here; documents never do.
    """
    everything = Window.partitionBy()
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("__level", "__nth")
    share_of = F.element_at(F.array(*map(F.lit, weights)), (F.col("__nth") % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("__nth", F.row_number().over(ranked) - 1)
        .withColumn("__weight", share_of.cast("double"))
        .withColumn("__most", F.lit(most) * F.col("source_size"))
        .withColumn("__level", F.col("__most") / F.col("__weight"))
        .withColumn("__budget", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("__full_before", F.coalesce(F.sum("__most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("__open", F.sum("__weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        # The level if this source and all later ones are open. It falls from the first source on that stays below its
        # most, and that source's level holds: the greatest among those.
        .withColumn("__try", (F.col("__budget") - F.col("__full_before")) / F.col("__open"))
        .withColumn("__at", F.max(F.when(F.col("__level") > F.col("__try"), F.col("__try"))).over(everything))
        .withColumn("target", F.least(F.col("__most"), F.coalesce(F.col("__at") * F.col("__weight"), F.col("__most"))))
        .select("source", "source_size", "target")
    )


def random_unit(*key: Column) -> Column:
    """A number in (0, 1) from the key: 52 bits of its MD5."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *key).cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def mix(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    importance: Column | None = None,
    seed: str = "mix",
    key: Column | None = None,
) -> DataFrame:
    """One row per document: all columns of `docs` plus size, source_size, target and taken (words, repeats counted).

    `taken` is size times the copies. A source's copies come within half of its marginal document of the target (unless
    the cap per document stands against it). `importance` (null: 1) bends the copies within a source; the source's sum
    stays. A null text has size 0 and is never taken; a source of no words has target 0; null is a source of its own. A
    repeated row is sampled with its equals: they share their rank, ordered further by nothing but the copies' number.
    `key` (text) is what u comes from in place of doc_id: by the id, rows of a null id all have one rank. The new columns
    replace columns of the same name. An empty frame gives none.
    """
    bent = F.lit(1.0) if importance is None else F.greatest(F.coalesce(importance.cast("double"), F.lit(1.0)), F.lit(0.0))
    added = ("size", "source_size", "target", "taken")
    own = [c for c in docs.columns if c not in added]
    rows = docs.select(
        *own,
        F.col("source").alias("__source"),
        word_count(F.col("text")).alias("__size"),
        bent.alias("__bent"),
        random_unit(F.lit(seed), F.coalesce(F.col("doc_id").cast("string") if key is None else key, F.lit(""))).alias("__u"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("__deal"),
    )
    sums = rows.groupBy(F.col("__source").alias("source")).agg(
        F.sum("__size").alias("source_size"), F.sum(F.col("__size") * F.col("__bent")).alias("__mass")
    )
    targets = source_targets(sums, weights, share, most).select(
        F.col("source").alias("__s"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target")
    )
    masses = sums.select(F.col("source").alias("__s"), "__mass")
    targets = targets.join(masses, targets["__s"].eqNullSafe(masses["__s"])).drop(masses["__s"])

    expected = F.when(
        F.col("__mass") > 0, F.least(F.lit(most), F.col("__target") / F.col("__mass") * F.col("__bent"))
    ).otherwise(0.0)
    ranked = (
        rows.join(targets, F.col("__source").eqNullSafe(F.col("__s")))
        .withColumn("__expected", expected)
        .withColumn("__sure", F.floor("__expected"))
        .withColumn("__p", F.col("__expected") - F.col("__sure"))
        .withColumn("__rank", F.try_divide(F.col("__u") / (1 - F.col("__u")) * (1 - F.col("__p")), F.col("__p")))
        # The slice is a growing function of the rank alone: rank / (1 + rank) lies in (0, 1).
        .withColumn("__slice", F.floor(F.col("__rank") / (1 + F.col("__rank")) * SLICES).cast("int"))
    )
    open_rows = (F.col("__p") > 0) & (F.col("__size") > 0)
    sure_words = F.col("__sure") * F.col("__size")
    slices = ranked.groupBy("__s", "__slice").agg(
        F.sum(sure_words).alias("__sure_words"),
        F.sum(F.when(open_rows, F.col("__size")).otherwise(0)).alias("__words"),
        F.max("__target").alias("__goal"),
    )
    source = Window.partitionBy("__s")
    rising = source.orderBy(F.col("__slice").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    # What each slice may still take: the whole of it, nothing, or, in one slice per source, a part.
    room = (
        slices.withColumn("__rest", F.col("__goal") - F.sum("__sure_words").over(source))
        .withColumn("__room", F.col("__rest") - F.coalesce(F.sum("__words").over(rising), F.lit(0)))
        .select(F.col("__s").alias("__rs"), F.col("__slice").alias("__rslice"), "__room", F.col("__words").alias("__slice_words"))
    )
    placed = ranked.join(
        room, F.col("__s").eqNullSafe(F.col("__rs")) & F.col("__slice").eqNullSafe(F.col("__rslice"))
    ).withColumn("__cut", open_rows & (F.col("__room") > 0) & (F.col("__room") < F.col("__slice_words")))
    # Only documents of the cut slices are ordered; all others are dealt by id and text, as ids may repeat.
    spread = F.when(F.col("__cut"), F.lit(-1)).otherwise(F.col("__deal"))
    order = Window.partitionBy("__s", spread.cast("long")).orderBy("__cut", "__rank", "__size", "doc_id")
    before = F.coalesce(
        F.sum(F.when(F.col("__cut"), F.col("__size"))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        placed.withColumn("__left", F.col("__room") - F.when(F.col("__cut"), before).otherwise(0))
        .withColumn(
            "__more",
            F.when(~open_rows, 0)
            .when(F.col("__cut"), (F.col("__left") * 2 >= F.col("__size")).cast("int"))
            .otherwise((F.col("__room") > 0).cast("int")),
        )
        .select(
            *own,
            F.col("__size").alias("size"),
            F.col("__source_size").alias("source_size"),
            F.col("__target").alias("target"),
            (F.col("__size") * (F.col("__sure") + F.coalesce("__more", F.lit(0)))).cast("long").alias("taken"),
        )
    )
