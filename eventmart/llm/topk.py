"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are put into buckets of similar length (a fixed factor apart), buckets into blocks of bounded size.
1. Each query meets one block of the longest bucket and gets a first threshold: its k-th best score there.
2. It then goes to the rest, to those buckets that can still hold a score as high: |q| * longest of the bucket >= threshold. Within
   a bucket the threshold over the lengths is a local cosine threshold. Where it is low, candidates are pruned by length
   (a prefix of the block, which is sorted by length); where it is high, by coordinates: a vector whose cosine with the
   query reaches t has each coordinate within q_f * t +- sqrt((1 - t^2)(1 - q_f^2)). Products of what is left are verified
   exactly in integers, and the block's own k-th best raises the threshold for the next query's candidates no more than
   the truth allows: pruning only ever uses bounds that hold.
3. Each block gives at most k rows per query; the best k of all are ranked.

Queries travel to the blocks they need by a shuffle, in groups of bounded size; nothing is broadcast but the table of
at most `LEVELS` buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.session import written

LEVELS = 64
FACTOR = 0.8
BLOCK = 2048
QUERIES = 256
#: Local cosine thresholds from here on are worth pruning by coordinates.
BY_COORDINATE = 0.5
FOCUS = 3
HIT = "query_id long, vec_id long, score long"


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, vector of integers as doubles, norm, dim); vectors null, empty or with null or non-finite parts are left out."""
    as_double = F.transform("embedding", lambda x: x.cast("double"))
    fine = ~F.exists(
        as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return (
        rows.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(as_double, lambda x: F.floor(x * scale).cast("double")).alias("v"),
        )
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
        .withColumn("dim", F.size("v"))
    )


def level_of(norm: Column, longest: Column) -> Column:
    """0 for the longest vectors, one more for each factor that a vector is shorter; the last level takes all the rest."""
    down = F.log(F.try_divide(norm, longest)) / float(np.log(FACTOR))
    return F.when(norm <= 0, LEVELS - 1).otherwise(F.least(F.lit(LEVELS - 1), F.greatest(F.lit(0), F.floor(down)))).cast("int")


def best_of_block(ids, vectors, norms, queries, k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's best k in a block sorted by length, longest first.

    `queries`: (id, vector, norm, threshold) with a threshold that k scores are known to reach, or minus infinity.
    """
    found = []
    for qid, q, qn, known in queries:
        keep = np.arange(len(ids))
        if known > -np.inf and qn > 0 and norms[0] > 0 and known > 0:
            local = known / (qn * norms[0])
            if local > 1 + 1e-9:
                continue
            # By length: |x| >= threshold / |q|.
            keep = keep[: int(np.searchsorted(-norms, -(known / qn) * (1 - 1e-9), side="right"))]
            if local >= BY_COORDINATE and len(keep):
                unit, lengths = q / qn, norms[keep]
                cosine = np.minimum(known / (qn * lengths), 1.0)
                for f in np.argsort(-np.abs(unit))[:FOCUS]:
                    slack = np.sqrt((1 - cosine**2) * (1 - unit[f] ** 2)) + 1e-7
                    here = vectors[keep, f] / lengths
                    fits = np.abs(here - unit[f] * cosine) <= slack
                    # Cosines above the threshold stay within the same bounds only while the bound on that side grows.
                    fits |= (here > unit[f] * cosine) & (unit[f] > cosine) | (here < unit[f] * cosine) & (unit[f] < -cosine)
                    keep, cosine, lengths = keep[fits], cosine[fits], lengths[fits]
        keep = keep[ids[keep] != qid]
        if not len(keep):
            continue
        scores = vectors[keep] @ q  # integers below 2**53: exact
        enough = scores >= known
        keep, scores = keep[enough], scores[enough]
        if len(keep) > k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep, scores = keep[scores >= edge], scores[scores >= edge]
        order = np.lexsort((ids[keep], -scores))[:k]
        found += [(int(qid), int(ids[keep[i]]), int(scores[i])) for i in order]
    return found


def search_blocks(k: int):
    """Rows in order of (dim, level, salt, lot, role): a block's candidates, then the queries of one lot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done(held):
            block = [r for r in held if r[0] == 0]
            asks = [(r[1], np.array(r[2]), r[3], r[4]) for r in held if r[0] == 1]
            if not block or not asks:
                return []
            block.sort(key=lambda r: (-r[3], r[1]))
            ids = np.array([r[1] for r in block], dtype=np.int64)
            return best_of_block(ids, np.array([r[2] for r in block]), np.array([r[3] for r in block]), asks, k)

        def rows(found):
            columns = list(zip(*found)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

        for batch in batches:
            columns = {c: batch.column(c) for c in ("dim", "level", "salt", "lot", "role", "vec_id", "norm", "known")}
            columns = {c: column.to_pylist() for c, column in columns.items()}
            vectors = batch.column("v")
            flat, edges = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            found = []
            for i in range(batch.num_rows):
                key = tuple(columns[c][i] for c in ("dim", "level", "salt", "lot"))
                if key != at:
                    found += done(held)
                    at, held = key, []
                known = columns["known"][i]
                v = flat[edges[i] : edges[i + 1]].copy()
                held.append((columns["role"][i], columns["vec_id"][i], v, columns["norm"][i], -np.inf if known is None else known))
            yield rows(found)
        yield rows(done(held))

    return run


def met(vectors: DataFrame, levels: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """Hits of `asks` (vec_id, v, norm, dim, level, known) in the blocks of their level."""
    lots = asks.groupBy("dim", "level").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("lots"))
    # At most LEVELS + 1 rows per dimension that occurs: sent to the vectors, which all have few keys here.
    table = F.broadcast(levels.join(lots, ["dim", "level"]))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    salt = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    lot = F.pmod(F.xxhash64(F.lit("lot"), "vec_id"), F.col("lots")).cast("int")
    shape = ["dim", "level", "salt", "lot", "role", "vec_id", "v", "norm", "known"]
    candidates = (
        vectors.join(table, ["dim", "level"])
        .withColumn("salt", salt)
        .withColumn("lot", numbers("lots"))
        .select(*shape[:4], F.lit(0).alias("role"), "vec_id", "v", "norm", F.lit(None).cast("double").alias("known"))
    )
    queries = (
        asks.join(table, ["dim", "level"])
        .withColumn("lot", lot)
        .withColumn("salt", numbers("blocks"))
        .select(*shape[:4], F.lit(1).alias("role"), "vec_id", "v", "norm", "known")
    )
    keys = ["dim", "level", "salt", "lot"]
    return candidates.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(search_blocks(k), HIT)


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row that `is_query` names.

    Components become floor(scale * x); the score is their inner product; ties go to the smaller vec_id. Vectors that are
    null, empty or hold null or non-finite components take no part, nor do rows of null id. Only vectors of equal
    dimension are compared. Rows of the query's own id are never its candidates; a repeated row is a candidate as often as it
    is there, and a query once. Fewer candidates than k give fewer rows; an empty frame gives none.
    """
    sized = whole_vectors(rows, scale)
    longest = sized.groupBy("dim").agg(F.max("norm").alias("longest"))
    vectors = sized.join(F.broadcast(longest), "dim").withColumn("level", level_of(F.col("norm"), F.col("longest"))).drop("longest")
    vectors = written(vectors, "vectors")
    # One block of the longest bucket goes first, as a bucket of its own before all others.
    counts = vectors.where("level = 0").groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    opens = (F.col("level") == 0) & (F.pmod(F.xxhash64(F.lit("first"), "vec_id"), F.col("parts")) == 0)
    # A dimension of zero vectors alone has no level 0 and opens with the level they have.
    vectors = vectors.join(F.broadcast(counts), "dim", "left").withColumn("level", F.when(opens, -1).otherwise(F.col("level"))).drop("parts")
    levels = written(
        vectors.groupBy("dim", "level").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.max("norm").alias("top"), F.count(F.lit(1)).alias("n")
        ),
        "levels",
    )
    queries = vectors.where(is_query).groupBy("vec_id", "dim").agg(F.min("v").alias("v"), F.min("norm").alias("norm"))
    # The first level that, with those before it, holds more than k others: the place of the first threshold.
    running = Window.partitionBy("dim").orderBy("level")
    first = (
        levels.withColumn("so_far", F.sum("n").over(running))
        .groupBy("dim")
        .agg(F.coalesce(F.min(F.when(F.col("so_far") > k, F.col("level"))), F.max("level")).alias("first"))
    )
    asks = queries.join(first, "dim").join(levels.select("dim", "level"), "dim").where("level <= first")
    opening = written(met(vectors, levels, asks.withColumn("known", F.lit(None).cast("double")).drop("first"), k), "hits")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    known = (
        opening.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") == k)
        .select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("known"))
    )
    later = (
        queries.join(first, "dim")
        .join(known, "vec_id", "left")
        .join(levels.select("dim", "level", "top"), "dim")
        .where("level > first and (known is null or norm * top * (1 + 1e-9) >= known)")
        .drop("first", "top")
    )
    hits = opening.unionByName(met(vectors, levels, later, k))
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
