"""URL verdicts by rules and by logistic regression on hashed character n-grams, in DataFrame functions only.

Host and path are framed by marks and cut into n-grams of three to five characters; each is hashed by CRC-32 into one of
`BUCKETS` buckets. The labelled table below is small and fixed, so that its hashed rows, made by the same
DataFrame expressions as those of the pages, are fitted on the driver; what is sent out is one array of `BUCKETS` weights,
whatever the size of the pages.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
SIZES = (3, 4, 5)

# (host, path, verdict): allow or block, longest rule first where several fit.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

# Labelled URLs, 1 = block. Kinds of hosts that filters block: betting, pills, adult, trackers, farms, scams.
BLOCKED = (
    "http://www.casino-royal.example.net/en/12",
    "https://win-casino.example.com/play?id=3",
    "https://casino-win.example.com/en/77",
    "https://slots-jackpot.example.net/bonus",
    "https://online-bets.example.com/odds",
    "http://free-bets.example.net/en/5",
    "https://sport-bets-free.example.com/de/9",
    "https://poker-free.example.net/tables",
    "http://cheap-pills.example.com/buy",
    "https://pills-discount.example.net/en/3",
    "https://www.cheap-meds.example.com/pills/1",
    "https://adult-x.example.net/videos/8",
    "https://m.adult-cams.example.com/x/2",
    "https://xxx-adult.example.net/en/1",
    "https://ads-track.example.com/pixel?u=1",
    "http://ads-server.example.net/click",
    "https://track-ads.example.com/en/90",
    "https://clicktracker.example.net/ads/7",
    "https://spam-farm.example.com/en/4",
    "http://link-farm.example.net/spam/12",
    "https://seo-spam.example.com/farm",
    "https://content-farm.example.net/fr/6",
    "https://win-prizes.example.com/claim",
    "https://loans-fast-cash.example.net/apply",
    "https://blog.xxx-adult.example.com/en/9",
    "https://blog.adult-films.example.org/es/70",
    "https://www.free-bets.example.org/fr/31",
    "https://m.pills-cheap.example.org/de/8",
    "http://blog.casino-slots.example.org/en/45.html",
    "https://spam-links.example.org/en/2",
    "https://ads-click.example.org/track/5",
)
ALLOWED = (
    "https://www.library.example.com/en/12",
    "https://blog.gardening.example.net/en/7",
    "http://news.morning.example.com/2023/05/story",
    "https://docs.python-guide.example.net/tutorial/3",
    "https://history.museum.example.com/fr/18",
    "https://m.weather.example.net/de/44",
    "https://www.university.example.com/research/9",
    "http://recipes.kitchen.example.net/en/300",
    "https://blog.theories.example.com/en/52",
    "https://www.thermal.example.net/fr/11",
    "https://m.nations.example.com/es/80",
    "https://other.example.net/en/61",
    "https://the-herald.example.com/en/909",
    "https://www.ontology.example.net/de/5",
    "https://blog.stations.example.com/en/233.html",
    "http://thesis.example.net/en/27?page=2",
    "https://physics.lectures.example.com/en/1",
    "https://www.health.example.net/en/94",
    "https://maps.example.com/fr/350",
    "https://m.journal.example.net/es/16",
    "http://wiki.tables.example.com/en/8/",
    "https://forum.cycling.example.net/de/71",
    "https://www.poetry.example.com/en/415",
    "https://archive.letters.example.net/en/6",
    "https://tables.example.org/en/33",
    "https://thanks.example.org/fr/2",
    "http://thursday.example.org/de/190",
    "https://nations.example.org/en/5107",
    "https://thinkers.example.com/en/4?utm_source=feed",
    "https://theatre.example.net/es/88#top",
    "http://thunder.example.com/en/3301.html",
    "https://stations.example.org/en/64/",
    "https://m.heather.example.com/en/12?page=2",
    "https://notable.example.org/de/7021",
    "http://other.example.com/es/15",
    "https://thatch.example.net/fr/640",
    "https://blog.weaver.example.org/en/2",
    "https://www.hedges.example.org/en/918",
)
LABELLED = tuple((url, 1) for url in BLOCKED) + tuple((url, 0) for url in ALLOWED)


def host_of(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule as host + path, its verdict) of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda rule: (len(rule[0] + rule[1]), rule)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def hashed_grams(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the distinct character n-grams of the framed host and path. A text too short for a size is one gram as a whole."""
    framed = F.concat(F.lit("^"), host, F.lit("|"), path, F.lit("$"))

    def of_size(size: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(framed) - (size - 1), F.lit(1)))
        return F.transform(places, lambda i: F.substring(framed, i, F.lit(size)))

    grams = [of_size(size) for size in SIZES]
    return F.transform(F.array_distinct(F.concat(*grams)), lambda g: (F.crc32(g.cast("binary")) % buckets).cast("int"))


def fit(rows: list[tuple[list[int], int]], buckets: int = BUCKETS, steps: int = 300, rate: float = 2.0, shrink: float = 1e-3):
    """(bias, weights) of logistic regression by full gradient steps; each row's features have norm one."""
    bias, weights = 0.0, [0.0] * buckets
    for _ in range(steps):
        slope, slopes = 0.0, {}
        for features, label in rows:
            scale = 1 / math.sqrt(len(features) or 1)
            margin = bias + scale * sum(weights[f] for f in features)
            miss = 1 / (1 + math.exp(-margin)) - label
            slope += miss
            for f in features:
                slopes[f] = slopes.get(f, 0.0) + miss * scale
        bias -= rate * slope / len(rows)
        for f, s in slopes.items():
            weights[f] -= rate * (s / len(rows) * 8 + shrink * weights[f])
    return bias, weights


def train(spark: SparkSession, labelled: tuple = LABELLED, buckets: int = BUCKETS) -> tuple[float, list[float]]:
    table = F.array(*(F.struct(F.lit(url).alias("url"), F.lit(label).alias("label")) for url, label in labelled))
    frame = spark.range(1, numPartitions=1).select(F.inline(table))
    rows = frame.select("url", "label", hashed_grams(host_of(F.col("url")), path_of(F.col("url")), buckets).alias("f")).collect()
    return fit([(row.f, row.label) for row in sorted(rows, key=lambda row: row.url)], buckets)


def url_filter(pages: DataFrame, rules: tuple = RULES, labelled: tuple = LABELLED) -> DataFrame:
    """All columns of `pages` plus host, path, rule, verdict and `block_score`, which replace columns of these names.

    A null url, or one without `://`, has empty host and path; no rule fits it and the model judges the empty frame.
    Repeated rows get equal verdicts; an empty frame gives none.
    """
    bias, weights = train(pages.sparkSession, labelled)
    added = ("host", "path", "rule", "verdict", "block_score")
    rows = pages.withColumn("__host", host_of(F.col("url"))).withColumn("__path", path_of(F.col("url")))
    rule, verdict = rule_of(F.col("__host"), F.col("__path"), rules)
    table = F.lit([float(w) for w in weights])
    total = F.aggregate(F.col("__grams"), F.lit(0.0), lambda s, g: s + F.get(table, g))
    margin = F.lit(bias) + total / F.sqrt(F.greatest(F.size("__grams"), F.lit(1)))
    return (
        rows.withColumn("__grams", hashed_grams(F.col("__host"), F.col("__path")))
        .withColumn("__score", 1 / (1 + F.exp(-margin)))
        .select(
            *(c for c in pages.columns if c not in added),
            F.col("__host").alias("host"),
            F.col("__path").alias("path"),
            rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("__score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
            F.col("__score").alias("block_score"),
        )
    )
