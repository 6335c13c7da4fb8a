"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification.

1. Words, shingle set and signature of every whole text; rows of equal sets become one class by a 128-bit set digest.
2. Banding: 50 bands of 6 hashes. Two sets of similarity 0.8 share no band with probability 2.5e-7; of similarity 0.05,
   one with 8e-7. Only buckets of two classes or more go on.
3. Star rounds: in each bucket, classes are compared with a leader, each class with the leader that it shares most
   bands with. A comparison looks at the signatures batch by batch and stops when the posterior probability
   that the similarity reaches the threshold falls below `MISS`; what survives is verified on the full sets.
4. Buckets whose classes are not yet all in one component hold pairs that may still be links. Small buckets give their
   pairs (a bounded number per class); for large ones, blocks of at most 512 by 512 classes are compared inside tasks, skipping
   pairs already in one component, so that pairs of a large group are never emitted and none is left out.
5. Connected components over all links.

Signatures and sets are kept for candidates alone, in a written table; text is read twice and is never shuffled unless
there are too many candidates to send their ids to all executors. Likewise a round's comparisons are sent to the sets, and only
the sets that the round needs are shuffled, once, to their comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.components import components
from eventmart.llm.words import find_words, mixed, portions, shingles
from eventmart.llm.worker import tidy
from eventmart.session import written

HASHES, BANDS = 300, 50
STEP = 50
MISS = 1e-6
SMALL_BUCKET = 16
STAR = 64
BLOCK = 512
#: Candidates up to this number (8 bytes each) are sent to all executors; beyond, texts are shuffled to them.
STARS = 10  # rounds of further leaders at most; what they leave open is compared in full
SLOW = 0.9  # a round that leaves more than this share open is the last one
SENT_IDS = 1_000_000
#: A round's rows of comparisons (some 40 bytes each) up to this number are sent to all executors; beyond, the sets are shuffled to them.
SENT_ROWS = 250_000

_random = np.random.default_rng(7)
_A = (_random.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _random.integers(0, 2**32, HASHES, dtype=np.uint32)[:, None]


def signature(members: np.ndarray) -> np.ndarray:
    """MinHash signature of a set of 64-bit hashes."""
    low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    x = (members >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(low, (x[None, at : at + 2048] * _A + _B).min(axis=1), out=low)
    return low


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, HASHES) -> (n, BANDS) 64-bit keys; a band's key holds the band's number."""
    parts = signatures.reshape(len(signatures), BANDS, HASHES // BANDS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        keys = mixed(keys * np.uint64(0x2545F4914F6CDD1D) + parts[:, :, k])
    return keys.view(np.int64)


def least_matches(percent: int, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, least matches to go on): with fewer, P(similarity >= percent / 100 | matches) < miss.

    With a flat prior, that posterior probability after m matches of n is P(Binomial(n + 1, t) <= m).
    """
    found = []
    t = percent / 100
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < miss and m <= n:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        found.append((n, m))
    return found


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted sets: percent * union <= 100 * intersection."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def may_be_alike(one: np.ndarray, other: np.ndarray, steps: list[tuple[int, int]]) -> bool:
    matches, before = 0, 0
    for n, least in steps:
        matches += int((one[before:n] == other[before:n]).sum())
        if matches < least:
            return False
        before = n
    return True


FIRST = "doc_id long, n int, d1 long, d2 long, bands array<long>"
FULL = "rep long, sig binary, members binary"
LINK = "a long, b long"


def first_pass(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            words = find_words(batch.column("text"))
            count = batch.num_rows
            n, digests, signatures = np.zeros(count, np.int32), np.zeros((count, 2), np.uint64), []
            for i in range(count):
                own = shingles(words.of(i), width)
                n[i] = len(own)
                digests[i] = mixed(own).sum(), mixed(own * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)).sum()
                if len(own):
                    signatures.append(signature(own))
            keys = band_keys(np.stack(signatures)) if signatures else np.zeros((0, BANDS), np.int64)
            offsets = np.concatenate([[0], np.cumsum((n > 0) * BANDS)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n),
                    pa.array(digests[:, 0].view(np.int64)),
                    pa.array(digests[:, 1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                names=["doc_id", "n", "d1", "d2", "bands"],
            )

    return run


def second_pass(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            words = find_words(batch.column("text"))
            sets = [shingles(words.of(i), width) for i in range(batch.num_rows)]
            keep = [i for i, own in enumerate(sets) if len(own)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(keep, pa.int64())),
                    pa.array([signature(sets[i]).tobytes() for i in keep], pa.binary()),
                    pa.array([sets[i].tobytes() for i in keep], pa.binary()),
                ],
                names=["rep", "sig", "members"],
            )

    return run


def _arrays(batch: pa.RecordBatch) -> tuple[list, list]:
    sigs = [np.frombuffer(x, dtype=np.uint32) for x in batch.column("sig").to_pylist()]
    sets = [np.frombuffer(x, dtype=np.uint64) for x in batch.column("members").to_pylist()]
    return sigs, sets


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"]
    )


def verify_star(percent: int):
    """Rows in order of (lead, salt, role): each leader is held while its members pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, at, leaders = least_matches(percent), None, []
        for batch in batches:
            sigs, sets = _arrays(batch)
            found = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("lead", "salt", "role", "rep")))
            for i, (lead, salt, role, rep) in enumerate(keys):
                if at != (lead, salt):
                    at, leaders = (lead, salt), []
                if role == 0:
                    leaders.append((sigs[i].copy(), sets[i].copy()))
                elif any(may_be_alike(s, sigs[i], steps) and alike(m, sets[i], percent) for s, m in leaders):
                    found.append((lead, rep))
            yield _links(found)

    return run


def compare_block(reps: list, comps: list, sides: list, sigs: list, sets: list, percent: int, steps: list) -> list:
    """Links that join components, among pairs of a left and a right row that share a band."""
    root = {c: c for c in comps}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    left, right = ([i for i, s in enumerate(sides) if s == side] for side in (0, 1))
    if not right:
        right = left
    if not left:
        return []
    matrix = np.stack(sigs)
    keys = band_keys(matrix)
    found = []
    right_keys, right_sigs = keys[right], matrix[right]
    for i in left:
        near = np.flatnonzero((right_keys == keys[i]).any(axis=1))
        near = near[[find(comps[right[j]]) != find(comps[i]) for j in near]] if len(near) else near
        matches, before = np.zeros(len(near), np.int64), 0
        for n, least in steps:  # batch by batch, the pruned ones leave
            matches += (right_sigs[near, before:n] == matrix[i, before:n]).sum(axis=1)
            near, matches, before = near[matches >= least], matches[matches >= least], n
        for j in near:
            other = right[j]
            one, two = find(comps[i]), find(comps[other])
            if one != two and alike(sets[i], sets[other], percent):
                root[max(one, two)] = min(one, two)
                found.append((reps[i], reps[other]))
    return found


def verify_blocks(percent: int):
    """Rows in order of (c1, c2): a pair of blocks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, at, held = least_matches(percent), None, ([], [], [], [], [])
        for batch in batches:
            sigs, sets = _arrays(batch)
            found = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("c1", "c2", "rep", "comp", "side")))
            for i, (c1, c2, rep, comp, side) in enumerate(keys):
                if at != (c1, c2):
                    found += compare_block(*held, percent, steps)
                    at, held = (c1, c2), ([], [], [], [], [])
                for store, value in zip(held, (rep, comp, side, sigs[i].copy(), sets[i].copy())):
                    store.append(value)
            yield _links(found)
        yield _links(compare_block(*held, percent, steps))

    return run


def with_sets(rows: DataFrame, full: DataFrame) -> DataFrame:
    """`rows` with the signature and set of their `rep`. The rows are small next to the sets, so it is they that move."""
    rows = written(rows, "wanted")
    return full.join(rows if rows.count() > SENT_ROWS else F.broadcast(rows), "rep")


def star_links(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(lead, rep) -> links (a, b). A leader with many members is given to several tasks, each with some of them.

    `pairs` is read three times, so it comes as a written table.
    """
    sizes = pairs.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / STAR).alias("salts"))
    members = pairs.join(sizes, "lead").select(
        "lead", F.pmod(F.xxhash64("rep"), "salts").alias("salt"), F.lit(1).alias("role"), "rep"
    )
    leaders = sizes.select(
        "lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("lead").alias("rep")
    )
    return (
        with_sets(members.unionByName(leaders), full)
        .repartition("lead", "salt")
        .sortWithinPartitions("lead", "salt", "role")
        .mapInArrow(tidy(verify_star(percent)), LINK)
    )


def best_leads(rows: DataFrame) -> DataFrame:
    """Of each class's leaders, the one met in most buckets, the smallest of equals."""
    counted = rows.where("rep <> lead").groupBy("rep", "lead").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("rep").agg(F.max(F.struct("n", (-F.col("lead")).alias("minus"))).alias("best"))
    return best.select("rep", (-F.col("best.minus")).alias("lead"))


def with_comp(rows: DataFrame, comps: DataFrame, column: str, name: str) -> DataFrame:
    """`rows` with the component of `column`, which is its own where it has no link."""
    own = comps.select(F.col("node").alias("__node"), F.col("comp").alias("__comp"))
    return (
        rows.join(own, rows[column] == own["__node"], "left")
        .withColumn(name, F.coalesce("__comp", column))
        .drop("__node", "__comp")
    )


def open_buckets(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """The rows, with their component, of buckets that hold two components or more."""
    rows = with_comp(buckets, comps, "rep", "comp")
    mixed_keys = rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    return rows.join(mixed_keys.select("key"), "key")


def block_links(rows: DataFrame, comps: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links between components in large open buckets.

    Classes are laid out in blocks by the largest bucket that they are in, so that classes of one group meet in few blocks.
    Large components have blocks of their own, whose pairs with themselves need no look; the classes of small ones and
    those still alone share blocks. Pairs of blocks that share a bucket are compared once.
    """
    sizes = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= BLOCK // 8)
    own = sizes.select("comp", F.col("comp").alias("own"))
    of_rep = Window.partitionBy("rep")  # at most a row per band
    at = rows.select("key", "rep", "comp", F.max(F.struct("m", "key")).over(of_rep).alias("at"))
    # A bucket's classes come to the greatest home among them, so that groups tied by few bands are not dealt over many blocks.
    tops = at.groupBy("key").agg(F.max("at").alias("top"))
    homes = at.join(tops, "key").select("key", "rep", "comp", F.max("top").over(of_rep)["key"].alias("home"))
    homes = homes.join(own, "comp", "left").withColumn("own", F.coalesce("own", F.lit(-1)))
    homes = written(homes, "homes")
    blocks = homes.groupBy("home", "own").agg(F.count_distinct("rep").alias("n")).select("home", "own", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    block = F.xxhash64("home", "own", F.pmod(F.xxhash64("rep"), "blocks"))
    placed = written(homes.join(blocks, ["home", "own"]).select("key", "rep", "comp", block.alias("c")), "placed")
    classes = written(placed.select("rep", "comp", "c").distinct(), "classes")
    per_key = placed.groupBy("key", "c").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    one = per_key.select("key", *(F.col(x).alias(f"{x}1") for x in ("c", "low", "high")))
    two = per_key.select("key", *(F.col(x).alias(f"{x}2") for x in ("c", "low", "high")))
    pairs = (
        one.join(two, "key")
        .where("c1 <= c2 and (low1 <> high1 or low2 <> high2 or low1 <> low2)")
        .select("c1", "c2")
        .distinct()
    )
    left = pairs.join(classes, pairs["c1"] == classes["c"]).select("c1", "c2", "rep", "comp", F.lit(0).alias("side"))
    right = (
        pairs.where("c1 <> c2")
        .join(classes, F.col("c2") == F.col("c"))
        .select("c1", "c2", "rep", "comp", F.lit(1).alias("side"))
    )
    return (
        with_sets(left.unionByName(right), full)
        .repartition("c1", "c2")
        .sortWithinPartitions("c1", "c2")
        .mapInArrow(tidy(verify_blocks(percent)), LINK)
    )


def find_links(source: DataFrame, bands: DataFrame, width: int, percent: int) -> DataFrame | None:
    """(node, comp) over classes with links; None if no two classes share a bucket."""
    # Dealt by key once, for the buckets' leaders and for the join with them; a key has at most one row of a class's bands.
    bands = bands.repartition("key")
    keys = (
        bands.groupBy("key")
        .agg(
            F.min("rep").alias("lead1"),
            F.max("rep").alias("lead2"),
            F.min_by("rep", F.xxhash64("rep")).alias("lead3"),
            F.count(F.lit(1)).alias("m"),
        )
        .where("lead1 <> lead2")
    )
    buckets = written(bands.join(keys, "key"), "buckets")
    candidates = written(buckets.select("rep").distinct(), "candidates")
    count = candidates.count()
    if not count:
        return None
    ids = candidates if count > SENT_IDS else F.broadcast(candidates)
    texts = source.join(ids, source["doc_id"] == candidates["rep"], "left_semi")
    full = written(texts.mapInArrow(tidy(second_pass(width)), FULL), "sets")

    first = written(best_leads(buckets.select("rep", F.col("lead1").alias("lead"))), "leads")
    links = written(star_links(first, full, percent), "links")
    comps = components(links)

    # Second star: other leaders, for classes that share a bucket with a component that is not theirs.
    rows = written(open_buckets(buckets, comps), "open")
    others = rows.select("rep", "comp", F.explode(F.array("lead1", "lead2", "lead3")).alias("lead"))
    others = with_comp(others, comps, "lead", "lead_comp").where("comp <> lead_comp")
    second = written(best_leads(others.join(first, ["rep", "lead"], "left_anti")), "leads")
    links2 = written(star_links(second, full, percent), "links")
    links = links.unionByName(links2)
    comps = components(links)

    # Further stars, each with other leaders, as long as they close buckets. A leader taken at random is most likely of its
    # bucket's largest component, so what is left of a group joins it round by round, with one comparison a class and round.
    rows = written(open_buckets(rows.drop("comp"), comps), "open")
    left = rows.count()
    for turn in range(STARS):
        if not left:
            break
        leads = rows.groupBy("key").agg(F.min_by("rep", F.xxhash64("rep", F.lit(turn))).alias("lead"))
        met = with_comp(rows.select("key", "rep", "comp").join(leads, "key"), comps, "lead", "lead_comp")
        further = written(best_leads(met.where("comp <> lead_comp")), "leads")
        more = written(star_links(further, full, percent), "links")
        links = links.unionByName(more)
        comps = components(links)
        rows = written(open_buckets(rows.drop("comp"), comps), "open")
        before, left = left, rows.count()
        if left > SLOW * before:
            break

    # Whatever is still open, in full.
    if not left:
        return comps
    small = rows.where(F.col("m") <= SMALL_BUCKET).select("key", "rep", "comp")
    other = small.select("key", F.col("rep").alias("lead"), F.col("comp").alias("lead_comp"))
    pairs = small.join(other, "key").where("lead < rep and comp <> lead_comp").select("lead", "rep").distinct()
    pairs = written(pairs.join(first, ["rep", "lead"], "left_anti"), "pairs")
    links = links.unionByName(star_links(pairs, full, percent))
    large = rows.where(F.col("m") > SMALL_BUCKET)
    if large.limit(1).count():
        links = links.unionByName(block_links(large, comps, full, percent))
    return components(links)


def near_dup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Sets of distinct `width`-word shingles, A-Z lower-cased, are linked when 100 * intersection >= percent * union. A
    document of fewer words has its whole sequence as one shingle; a null, empty or blank text has none and is linked
    with nothing. component_id is the smallest doc_id reachable. Rows that share a doc_id are one document, whose texts'
    links all count. A row of null doc_id can be linked with nothing: its component is null and it is kept. Other columns
    are ignored; an empty frame gives none.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = written(source.mapInArrow(tidy(first_pass(width)), FIRST), "rows")
    whole = rows.where("n > 0 and doc_id is not null")
    classes = written(whole.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    heads = whole.join(
        classes.select(F.col("d1").alias("h1"), F.col("d2").alias("h2"), F.col("n").alias("hn"), F.col("rep").alias("hr")),
        (F.col("d1") == F.col("h1")) & (F.col("d2") == F.col("h2")) & (F.col("n") == F.col("hn")) & (F.col("doc_id") == F.col("hr")),
        "left_semi",
    )
    bands = heads.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("key"))
    found = find_links(source, bands, width, percent)
    keyed = rows.select("doc_id", "n", "d1", "d2").join(classes, ["d1", "d2", "n"], "left")
    # Equal sets under one id with other texts join their classes; only then can a class hold an id that is not its head.
    twice = whole.groupBy("doc_id").agg(F.count_distinct("d1", "d2").alias("texts")).where("texts > 1").select("doc_id")
    ties = whole.join(twice, "doc_id").join(classes, ["d1", "d2", "n"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    if ties.limit(1).count():
        ties = ties.unionByName(found.select(F.col("comp").alias("a"), F.col("node").alias("b"))) if found is not None else ties
        found = components(ties)
    if found is None:
        component = keyed.withColumn("component_id", F.coalesce("rep", "doc_id"))
    else:
        component = with_comp(keyed.withColumn("rep", F.coalesce("rep", "doc_id")), found, "rep", "component_id")
    return component.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay, all columns: those of the smallest doc_id of each component."""
    gone = near_dup(docs, width, percent).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
