"""Spelling variants: words one edit apart, by k-d trees over letter counts.

One replaced letter changes two letter counts by one each, one inserted or deleted letter changes one. So near words lie
within an L1 distance of two between vectors of letter counts, and only pairs of equal lengths or of lengths one apart matter.

Per word length a k-d tree divides the words into leaves. Its splits are fitted on the driver to a bounded sample of the
length's words (SAMPLE of them at most), every word is put into its leaf. Each word then visits the leaves of its own
length (those after its own leaf: each pair meets once) and of the next length whose boxes lie within the distance. A leaf keeps
its words in a local tree with tight boxes; visitors stream past it, and pairs within the distance are verified letter by letter.

Cases: a null text has no words; a null doc_id is an empty text in the key of a deletion; repeated rows count each; a word of any
length is whole. Empty tables give no row. Of equally frequent near words the first in code-point order is the form. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import lower_az, whole_text
from eventmart.session import written

SHORTEST = 6
LEAST = 5  # occurrences of a word that counts
RATIO = 5  # a form is this much more frequent
EVERY = 199  # a run whose key's CRC-32 this number divides loses a letter
LEAF = 8192
SAMPLE = 16_384
LOCAL_LEAF = 96
VISITORS = 4096
PAIRS = 4_000_000  # letters compared at once
# Letters of a word: a-z and U+00C0 to U+00FF, each a coordinate.
LETTERS = "a-zÀ-ÿ"
DIMENSIONS = 26 + 64


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """Words of at least `shortest` letters with at least `least` occurrences (n) over all texts."""
    text = lower_az(whole_text(F.col("text")))
    runs = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    key = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (key % F.length("run")).cast("int")
    run = F.col("run")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    words = rows.select(F.when(key % EVERY == 0, cut).otherwise(run).alias("word"))
    counted = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least)


# --- Vectors -----------------------------------------------------------------------------------------------------

_PLACE = np.zeros(256, dtype=np.int64)
_PLACE[ord("a") : ord("z") + 1] = np.arange(26)
_PLACE[0xC0:0x100] = 26 + np.arange(64)


def letters_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    length = len(words[0]) if words else 0
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), length)


def vectors_of(letters: np.ndarray) -> np.ndarray:
    """Letter counts, a row each; floats that hold all counts and products exactly."""
    n, length = letters.shape
    at = _PLACE[letters] + np.arange(n, dtype=np.int64)[:, None] * DIMENSIONS
    counts = np.bincount(at.ravel(), minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    return counts.astype(np.float32 if length <= 4096 else np.float64)


def best_split(points: np.ndarray) -> tuple[int, float] | None:
    """The coordinate and threshold (left: at most) that halve the points best; None if all are alike."""
    middle = np.median(points, axis=0)
    best = None
    for threshold in (np.floor(middle), np.floor(middle) - 1):
        left = (points <= threshold).sum(axis=0)
        balance = np.minimum(left, len(points) - left)
        at = int(balance.argmax())
        if balance[at] > 0 and (best is None or balance[at] > best[0]):
            best = (balance[at], at, float(threshold[at]))
    return None if best is None else best[1:]


# --- The tree that deals words to tasks --------------------------------------------------------------------------


class DealingTree:
    """Splits of one word length. Leaves are numbered from left to right."""

    def __init__(self, sample: np.ndarray | None, leaves: int):
        self.leaves = 0
        self.root = self._grow(sample, leaves)

    def _grow(self, points, leaves: int):
        split = best_split(points) if points is not None and leaves > 1 and len(points) > 1 else None
        if split is None:
            self.leaves += 1
            return self.leaves - 1
        at, threshold = split
        left = points[:, at] <= threshold
        return at, threshold, self._grow(points[left], leaves // 2), self._grow(points[~left], leaves - leaves // 2)

    def home(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int64)

        def walk(node, rows):
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                left = points[rows, node[0]] <= node[1]
                walk(node[2], rows[left])
                walk(node[3], rows[~left])

        walk(self.root, np.arange(len(points)))
        return out

    def visits(self, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves whose boxes lie within an L1 distance of `reach`, each with the points that reach them.

        A box is known by its splits; a point outside of one is at least the way to the threshold off in that coordinate.
        """

        def walk(node, rows, low, high, gap):
            if not len(rows):
                return
            if isinstance(node, int):
                yield node, rows
                return
            at, threshold, left, right = node
            values = points[rows, at]
            old_low, old_high = low.get(at, -np.inf), high.get(at, np.inf)
            off = np.maximum(old_low - values, 0) + np.maximum(values - old_high, 0)
            for child, bound, side in ((left, high, threshold), (right, low, threshold + 1)):
                way = np.maximum(values - side, 0) if bound is high else np.maximum(side - values, 0)
                # The new bound is the stricter one on its side; the other side's distance stays.
                other = np.maximum(old_low - values, 0) if bound is high else np.maximum(values - old_high, 0)
                now = gap - off + way + other
                near = now <= reach
                narrowed = {**bound, at: side}
                if bound is high:
                    yield from walk(child, rows[near], low, narrowed, now[near])
                else:
                    yield from walk(child, rows[near], narrowed, high, now[near])

        yield from walk(self.root, np.arange(len(points)), {}, {}, np.zeros(len(points)))


def fit_trees(words: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> dict[int, DealingTree]:
    """A tree for each length that has more words than a leaf holds; other lengths are one leaf each."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf)
    wanted = {row["length"]: row["n"] for row in sizes.collect()}
    if not wanted:
        return {}
    # Words whose hash lies below their length's share, so at most about `sample` of a length; the same in every run.
    parts = 1 << 20
    shares = F.create_map(*(F.lit(x) for length, n in wanted.items() for x in (length, min(parts, parts * sample // n))))
    chosen = words.where(F.pmod(F.xxhash64("word"), F.lit(parts)) < F.element_at(shares, F.length("word")))
    by_length: dict[int, list[str]] = {length: [] for length in wanted}
    for row in chosen.select("word").sort("word").toLocalIterator():
        by_length[len(row["word"])].append(row["word"])
    return {
        length: DealingTree(vectors_of(letters_of(found)) if found else None, min(-(-wanted[length] // leaf), max(1, len(found) // 8)))
        for length, found in by_length.items()
    }


DEALT = "length long, leaf long, visitor int, word string, n long"
_ONE_LEAF = DealingTree(None, 1)


def deal(words: DataFrame, trees: dict[int, DealingTree]) -> DataFrame:
    """Every word as a member of its leaf and as a visitor of all leaves that may hold longer or later near words."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
    names = ["length", "leaf", "visitor", "word", "n"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = batch.column(0), batch.column(1)
            texts = word.to_pylist()
            lengths = np.array([len(w) for w in texts], dtype=np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                own, longer = trees.get(int(length), _ONE_LEAF), trees.get(int(length) + 1, _ONE_LEAF)
                for some in np.array_split(rows, -(-len(rows) * (int(length) + DIMENSIONS) // PAIRS)):
                    points = vectors_of(letters_of([texts[i] for i in some]))
                    home = own.home(points)
                    sent = [(length, home, 0, some)]
                    for leaf, near in own.visits(points, 2):
                        near = near[home[near] < leaf]
                        sent.append((length, np.full(len(near), leaf), 1, some[near]))
                    for leaf, near in longer.visits(points, 1):
                        sent.append((length + 1, np.full(len(near), leaf), 1, some[near]))
                    for size, leaf, visitor, who in sent:
                        if len(who):
                            at = pa.array(who)
                            columns = [np.full(len(who), size), leaf, np.full(len(who), visitor, dtype=np.int32)]
                            arrays = [pa.array(c, t) for c, t in zip(columns, types)] + [word.take(at), n.take(at)]
                            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return words.select("word", "n").mapInArrow(send, DEALT)


# --- Search within a leaf ----------------------------------------------------------------------------------------


class LeafTree:
    """Words of one leaf under tight boxes of their vectors."""

    def __init__(self, words: list[str]):
        self.letters = letters_of(words)
        self.points = vectors_of(self.letters)
        self.squares = (self.points**2).sum(axis=1)
        self.root = self._grow(np.arange(len(words)))

    def _grow(self, rows: np.ndarray):
        points = self.points[rows]
        box = (points.min(axis=0), points.max(axis=0))
        split = best_split(points) if len(rows) > LOCAL_LEAF else None
        if split is None:
            return box, rows, None, None
        left = points[:, split[0]] <= split[1]
        return box, None, self._grow(rows[left]), self._grow(rows[~left])

    def candidates(self, vectors: np.ndarray, reach: int, wanted: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (visitor, word) whose letter counts differ as one edit makes them.

        With sums equal, or one apart, an L1 distance of two, or one, is the same as a squared distance of `wanted`.
        """
        squares = (vectors**2).sum(axis=1)
        open_ = [(self.root, np.arange(len(vectors)))]
        while open_:
            (box, rows, left, right), some = open_.pop()
            mine = vectors[some]
            gap = (np.maximum(box[0] - mine, 0) + np.maximum(mine - box[1], 0)).sum(axis=1)
            some = some[gap <= reach]
            if not len(some):
                continue
            if rows is None:
                open_ += [(left, some), (right, some)]
                continue
            for start in range(0, len(rows), VISITORS):  # words of equal letters may be many
                part = rows[start : start + VISITORS]
                distance = squares[some][:, None] + self.squares[part][None, :] - 2 * (vectors[some] @ self.points[part].T)
                i, j = np.nonzero(distance == wanted)
                yield some[i], part[j]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each `long` row is its `short` row with one more letter: equal up to a place, shifted by one from it."""
    before = np.cumprod(short == long[:, :-1], axis=1, dtype=np.int8).sum(axis=1)
    after = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1)
    return before + after >= short.shape[1]


def near_pairs(tree: LeafTree, visitors: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs (visitor, word of the leaf); visitors have the leaf's length or one less."""
    letters = letters_of(visitors)
    same = letters.shape[1] == length
    verify = one_replaced if same else one_inserted
    step = max(1, PAIRS // max(1, length))
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    for i, j in tree.candidates(vectors_of(letters), 2 if same else 1, 2 if same else 1):
        for start in range(0, len(i), step):
            a, b = i[start : start + step], j[start : start + step]
            right = verify(letters[a], tree.letters[b])
            found.append((a[right], b[right]))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


PARTS = "word string, n long, n_near long, best_n long, best string"


def best_partners(words: list[str], n: np.ndarray, i: np.ndarray, j: np.ndarray, others: list[str], other_n: np.ndarray) -> pa.RecordBatch:
    """Per word i of pairs (i, j): how many partners, and the most frequent one (ties: first in code-point order)."""
    order = np.empty(len(others), dtype=np.int64)
    order[sorted(range(len(others)), key=others.__getitem__)] = np.arange(len(others))
    by = np.lexsort((order[j], -other_n[j], i))
    i, j = i[by], j[by]
    who, first, count = np.unique(i, return_index=True, return_counts=True)
    best = j[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[k] for k in who], pa.string()),
            pa.array(n[who], pa.int64()),
            pa.array(count, pa.int64()),
            pa.array(other_n[best], pa.int64()),
            pa.array([others[k] for k in best], pa.string()),
        ],
        names=["word", "n", "n_near", "best_n", "best"],
    )


def search_leaves(dealt: DataFrame) -> DataFrame:
    """Partial counts and best partners of near words, for both words of every pair.

    A task holds the words of one leaf; its visitors come after them, a batch at a time.
    """
    keys = ["length", "leaf"]
    rows = dealt.repartition(*keys).sortWithinPartitions(*keys, "visitor", F.length("word"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, counts, tree = None, [], [], None

        def inner():
            """The pairs within the leaf, a slice of its words at a time as visitors."""
            for start in range(0, len(words), VISITORS):
                i, j = near_pairs(tree, words[start : start + VISITORS], len(words[0]))
                # Each pair turns up from both its words, and each time for the visitor alone.
                if len(i):
                    some = np.array(counts[start : start + VISITORS])
                    yield best_partners(words[start : start + VISITORS], some, i, j, words, np.array(counts))

        for batch in batches:
            length, leaf, visitor = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            texts, n = batch.column(3).to_pylist(), batch.column(4).to_numpy(zero_copy_only=False)
            sizes = np.array([len(w) for w in texts])
            marks = np.stack([length, leaf, visitor, sizes])
            edges = [0, *(1 + np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0))), len(texts)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                mine = (int(length[start]), int(leaf[start]))
                if mine != key:
                    if words and tree is None:
                        tree = LeafTree(words)
                        yield from inner()
                    key, words, counts, tree = mine, [], [], None
                if visitor[start] == 0:
                    words += texts[start:end]
                    counts += n[start:end].tolist()
                    continue
                if not words:
                    continue
                if tree is None:
                    tree = LeafTree(words)
                    yield from inner()
                for at in range(start, end, VISITORS):
                    some, some_n = texts[at : min(end, at + VISITORS)], n[at : min(end, at + VISITORS)]
                    i, j = near_pairs(tree, some, len(words[0]))
                    if len(i):
                        yield best_partners(some, some_n, i, j, words, np.array(counts))
                        yield best_partners(words, np.array(counts), j, i, some, some_n)
        if words and tree is None:
            tree = LeafTree(words)
            yield from inner()

    return rows.mapInArrow(run, PARTS)


# --- Forms and roots ---------------------------------------------------------------------------------------------


def with_roots(words: DataFrame) -> DataFrame:
    """Follows forms to their end. A form is at least RATIO times as frequent, so no chain is longer than 27 words.

    Each round doubles the reach of every word; a round without a change ends it.
    """
    steps = written(words.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        moved = F.col("__next").isNotNull().alias("moved")
        joined = steps.join(further, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), moved)
        joined = written(joined, "roots")
        steps = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            break
    roots = steps.withColumnRenamed("root", "__root")
    return words.join(roots, "word", "left").withColumn("root", F.coalesce("__root", "word")).drop("__root")


def variants(docs: DataFrame, leaf: int = LEAF, sample: int = SAMPLE, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = written(word_counts(docs), "words")
    parts = search_leaves(deal(words, fit_trees(words, leaf, sample)))
    none = [F.lit(value).cast(kind).alias(name) for value, kind, name in ((0, "long", "n_near"), (None, "long", "best_n"), (None, "string", "best"))]
    own = words.select("word", "n", *none)
    # The least of (-n, word): the most frequent partner, the first one of equals.
    best: Column = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))))
    found = own.unionByName(parts).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    chosen = -F.col("best.less") >= ratio * F.col("n")
    found = found.select(
        "word",
        "n",
        "n_near",
        F.when(chosen, F.col("best.word")).alias("form"),
        F.when(chosen, -F.col("best.less")).alias("form_n"),
    )
    return with_roots(written(found, "variants")).select("word", "form", "root", "n", "n_near", "form_n")
