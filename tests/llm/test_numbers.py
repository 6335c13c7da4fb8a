"""Packing, mixing and top-k search, and the pipeline over them."""

from __future__ import annotations

import hashlib
import os
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from eventmart.llm import packing, pareto_mix, queries, topk
from eventmart.llm.common import table

SMALL = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def check_packed(pieces, docs, capacity=4096):
    """Exact round trip: pieces tile each document and each sequence, and hold the tokenizer's ids."""
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {i for i, _ in docs}
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        own, at = sorted(by_doc[i], key=lambda r: r.start), 0
        for r in own:
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        used += at if at & (at - 1) == 0 else capacity
    return used / sum(r.length for r in pieces)


EDGES = [
    (1, "It's x!'s <|endoftext|>a ABC,, é, É. ß! \x1c q z ﬁ İ 12a3 don't. '"),
    (2, None),
    (3, ""),
    (4, "a" * 3000 + " \x85\u3000b"),
    (5, "Σς Σ. naïve, œuvre! «é»,\r\n\tx"),
    (6, "le mot et la phrase " * 6000),
    (7, "<|ENDOFTEXT|> e\u0301 é"),
]


def test_pack_edges(spark):
    frame = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("length", F.lit("clash")).repartition(3)
    check_packed(packing.pack(frame, queries.tokenizer_path()).collect(), EDGES)
    assert packing.pack(frame.limit(0), queries.tokenizer_path()).count() == 0


def test_pack_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").repartition(7)
    padded = check_packed(queries.op2(spark, "/root/testdata/sf0.01").collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert padded < 1.01


def test_repeated_and_null_ids_pack(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    got = packing.pack(frame, queries.tokenizer_path()).collect()
    assert sorted((str(r.doc_id), r.length) for r in got) == [("1", 3), ("1", 3), ("None", 2)]
    assert len({(r.sequence_id, r.offset) for r in got}) == 3


def test_pieces_are_reciprocal_shares():
    for total in (1, 63, 64, 65, 4095, 4096, 4097, 10_000, 123_456):
        lengths = packing.pieces_of(total)
        assert sum(lengths) == total and all(n < 64 or 4096 % n == 0 for n in lengths)


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = budget - sum(2 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_mix(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(600):
        source = [None, "a", "b", "Z", "é", "tiny"][min(5, int(rng.exponential(1.2)))]
        rows.append((i, " ".join("w" * int(k) for k in rng.integers(1, 4, int(rng.integers(0, 60)))), source))
    rows += [(1000, None, "a"), (1001, "", "none"), (None, "x y", "b"), (5, "again", "b"), (5, "again", "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).repartition(4)
    got = pareto_mix.mix(frame).collect()
    assert len(got) == len(rows) and len(got[0].__fields__) == len(set(got[0].__fields__))
    sizes, taken, largest = {}, {}, {}
    for r in got:
        assert r.size == len((r.text or "").split()) and 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    targets = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6
    again = pareto_mix.mix(frame.repartition(9)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in got) == sorted((str(r.doc_id), r.taken) for r in again)


def test_mix_by_importance_and_empty(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bent = pareto_mix.mix(frame, share=0.5, importance=F.when(F.col("doc_id") < 200, 3.0).otherwise(1.0)).collect()
    low, high = (sum(r.taken for r in bent if (r.doc_id < 200) == side) for side in (False, True))
    assert high > 2 * low > 0
    assert pareto_mix.mix(frame.limit(0)).count() == 0


def brute_top(rows, k, step):
    usable = [(i, np.floor(256 * np.array(v, dtype=float))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    found = set()
    for i, q in {i: v for i, v in usable if i % step == 0}.items():
        best = sorted((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q))[:k]
        found |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    return found


def test_top_k_of_any_lengths(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 256)
    monkeypatch.setattr(topk, "QUERIES", 16)
    rng = np.random.default_rng(0)
    rows = [(int(i), [float(x) for x in rng.normal(size=8) * rng.lognormal(0, 1.5)]) for i in range(2500)]
    # Clusters of near-equal directions: high local thresholds.
    rows += [(3000 + i, [float(x) for x in (np.ones(8) + rng.normal(size=8) * 0.02) * rng.uniform(5, 9)]) for i in range(300)]
    rows += [(7000, None), (7050, [float("nan")] * 8), (7100, [1.0, None] + [0.0] * 6), (7150, []), (7200, [0.0] * 8)]
    rows += [(7250, [1.0, 2.0]), (7251, [1.0, 2.0]), (None, [1.0] * 8), (3, [5.0] * 8), (3, [5.0] * 8)]
    rows += [(8000 + i, [3.0] * 8) for i in range(60)]  # ties
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("level", F.lit("clash")).repartition(5)
    got = {tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0, 5).collect()}
    assert got == brute_top(rows, 5, 50)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_zero_vectors_alone(spark):
    rows = [(i, [0.003] * 4) for i in range(30)] + [(100 + i, [1.0 + i, 2.0]) for i in range(8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 10 == 0, 5).collect()} == brute_top(rows, 5, 10)


def test_pruning_never_loses_a_hit():
    rng = np.random.default_rng(5)
    for _ in range(200):
        vectors = np.floor(rng.normal(size=(200, 6)) * 50 + rng.normal(size=6) * 80)
        norms = np.linalg.norm(vectors, axis=1)
        order = np.argsort(-norms)
        vectors, norms, ids = vectors[order], norms[order], np.arange(200)
        q = np.floor(rng.normal(size=6) * 60)
        scores = vectors @ q
        known = float(np.sort(scores)[-int(rng.integers(1, 8))])
        got = topk.best_of_block(ids, vectors, norms, [(-1, q, float(np.linalg.norm(q)), known)], 5)
        best = sorted(((-int(s), i) for i, s in enumerate(scores) if s >= known))[:5]
        assert [(j, s) for _, j, s in got] == [(i, -s) for s, i in best]


def test_pipeline_stages(spark):
    """Each stage on what the one before kept; the last by an exact round trip."""
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SMALL).cache())
        assert kept[-1].columns == columns, name
    rows = [[(r.doc_id, r.text) for r in k.collect()] for k in kept]
    assert len(rows[0]) >= len(rows[1]) >= len(rows[2]) >= len(rows[3]) > 0
    assert len({t.lower() for _, t in rows[2]}) == len(rows[2])
    assert {i for i, _ in rows[4]} <= {i for i, _ in rows[3]}
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SMALL).collect()
    want = sum(r.length for r in packed)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    assert want == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows[4])


def test_mixed_with_null_and_repeated_ids(spark):
    """A third of the rows without id, others sharing one: each row comes as often as its own mix says, by brute force."""
    texts = [f"t{i} " + "w " * (i % 23) for i in range(900)]
    ids = [None if i % 3 == 0 else 7 if i % 30 == 1 else i for i in range(900)]
    rows = [(n, t, "abc"[i % 3 if i % 7 else 0], i, "clash") for i, (n, t) in enumerate(zip(ids, texts))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, taken string").repartition(5)
    got = corpus_pipeline.mixed(spark, docs, SMALL)
    assert got.columns == docs.columns
    times = Counter((r.doc_id, r.text, r.source, r.size, r.taken) for r in got.collect())
    assert set(times) <= {(n, t, s, i, c) for n, t, s, i, c in rows}
    assert max(times.values()) <= 2
    words, sizes, largest, taken = {r: len(r[1].split()) for r in rows}, Counter(), Counter(), Counter()
    for r in rows:
        sizes[r[2]] += words[r]
        largest[r[2]] = max(largest[r[2]], words[r])
    targets = brute_targets(dict(sizes))
    by_rank = {}
    for r in rows:
        key = str(r[0]) if r[0] is not None else "text " + hashlib.md5(r[1].encode()).hexdigest()
        u = (int(hashlib.md5(f"mix|{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        expected = min(2.0, targets[r[2]] / sizes[r[2]])
        taken[r] = int(expected)
        by_rank.setdefault((r[2], expected - int(expected)), []).append((u, words[r], r[0] or 0, r))
    for (s, p), ranked in by_rank.items():
        left = targets[s] - sum(taken[r] * words[r] for r in rows if r[2] == s)
        for _, size, _, r in sorted(ranked, key=lambda x: x[:3]) if p > 0 else ():
            taken[r] += left * 2 >= size
            left -= size
    for s in sizes:
        assert abs(sum(n * words[r] for r, n in times.items() if r[2] == s) - targets[s]) <= largest[s] / 2 + 1e-6
    # Equal ranks and sizes of one id are taken in any order.
    for told in (True, False):
        assert sorted((n, words[r]) for r, n in times.items() if (r[0] != 7) == told) == sorted(
            (n, words[r]) for r, n in taken.items() if n and (r[0] != 7) == told
        )
    assert {r: n for r, n in times.items() if r[0] != 7} == {r: n for r, n in taken.items() if n and r[0] != 7}


def test_the_rest_stands_without_this_package(tmp_path):
    """A copy without llm and pipeline imports and registers the other queries."""
    import shutil

    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "run-*"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and e.oracle_sql(); assert not any(n.startswith('op') and n[2].isdigit() for n in q), q; assert 'pipeline' not in q"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "copy", check=True, timeout=120)
