"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eventmart.llm import spelling


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(docs):
    counts: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    form, found = {}, {}
    for w, n in words.items():
        partners = [v for v in words if abs(len(v) - len(w)) <= 1 and near(v, w)]
        best = min(partners, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        found[w] = len(partners)
    rows = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, found[w], words[form[w]] if form[w] else None))
    return rows


def varied(rng: random.Random, word: str) -> str:
    at, letter = rng.randrange(len(word)), rng.choice("abeéÀ")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


def made(seed: int, n_words: int):
    """Texts of a few syllables' words, their variants and variants of those, anagrams, and very frequent ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(["an", "en", "ti", "ô", "ré", "s"], k=rng.randint(3, 5))) for _ in range(n_words)]
    words += [varied(rng, w) for w in words for _ in range(3) if len(w) > 1]
    words += ["".join(rng.sample(w, len(w))) for w in words[:n_words]]
    tokens = [w for w in words for _ in range(rng.choice([1, 5, 6, 40, 200]))]
    rng.shuffle(tokens)
    docs = [(i, " ".join(tokens[i::60])) for i in range(60)]
    return docs + [(None, "Antiré antiré, ANTIRÉ antirÉ! antire antiré"), (61, None), (62, ""), (63, "antiré " * 7)] * 2


@pytest.mark.parametrize(("leaf", "sample"), [(8192, 16_384), (40, 200), (20, 10**6)])
def test_variants(spark, leaf, sample):
    docs = made(3, 60)
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, word string, n int, leaf int")
    got = spelling.variants(frame.repartition(5), leaf=leaf, sample=sample).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == brute(docs)


def test_chain_of_forms(spark):
    words = {"banane": 5, "bananen": 25, "bananend": 125, "bananendo": 700, "xxxxxx": 9}
    frame = spark.createDataFrame([(i, f"{w} " * n) for i, (w, n) in enumerate(words.items())], "doc_id long, text string")
    got = {r.word: r for r in spelling.variants(frame).collect()}
    want = {r[0]: r for r in brute([(i, f"{w} " * n) for i, (w, n) in enumerate(words.items())])}
    assert {w: tuple(r) for w, r in got.items()} == want


def test_long_and_no_words(spark):
    long = "ab" * 30_000
    rows = [(i, f"{long} {long[:-1]} {long}c") for i in range(6)]
    got = {r.word: r.n_near for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[long] == 2 and len(got) == 3
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).collect() == []


def test_boxes_miss_no_near_word():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abcdé", k=7)) for _ in range(3000)})
    points = spelling.vectors_of(spelling.letters_of(words))
    tree = spelling.DealingTree(points, 32)
    assert tree.leaves == 32
    home = tree.home(points)
    reached = {(int(row), leaf) for leaf, rows in tree.visits(points, 2) for row in rows}
    distance = np.abs(points[:200, None] - points[None]).sum(axis=2)
    assert all((int(i), int(home[j])) in reached for i, j in zip(*np.nonzero(distance <= 2)))
    assert len(reached) < 0.9 * 32 * len(words)


def test_one_edit():
    rng = random.Random(2)
    for _ in range(500):
        a = "".join(rng.choices("ab", k=rng.randint(1, 6)))
        b = "".join(rng.choices("ab", k=len(a) + rng.randint(0, 1)))
        check = spelling.one_replaced if len(a) == len(b) else spelling.one_inserted
        assert check(spelling.letters_of([a]), spelling.letters_of([b]))[0] == near(a, b), (a, b)
