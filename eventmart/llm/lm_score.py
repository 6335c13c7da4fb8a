"""Language-model scores by deleted interpolation of n-grams.

P(w | h) = l2 * c(h, w) / c(h) + l1 * c(w) / N + l0 / (V + 1), where the weights depend on a bucket of the context's
frequency c(h). They are learned by expectation-maximisation on documents held out of the counts: those of the tuning
fold, scored with the counts of all other training documents. Final scores use the counts of all training documents.

A corpus has nearly as many distinct n-grams as tokens, so that rows per token are avoided:
1. Consecutive documents of an input partition form a block of bounded text; blocks are written to the shared folder.
2. Each block sends its distinct words and word pairs, as sorted 64-bit hashes with counts, to buckets of the hash range.
3. A bucket adds the counts of all blocks and returns to each block the totals of the keys that it sent. Buckets are
   uniform whatever the words' frequencies, and there are as many of them as the tokens ask for.
4. Each block looks its tokens up in what came back; per token only two counts are kept, packed.
5. EM runs over a histogram of the tuning tokens (bucket and two quantised ratios), whose size does not grow with the input;
   then every document is scored from its kept counts.

Words are told apart by their bucket's bits and 48 more, pairs by 40 more; buckets, and with them these bits, grow in number
with the input. Sorted keys travel as differences, in as few bytes as the largest needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.words import END, find_words, mixed, portions
from eventmart.session import written

BLOCK_BYTES = 12_000_000
BUCKET_KEYS = 1_500_000
# Bytes of a key within its bucket, of words and of pairs.
KEY_BYTES = (6, 5)
LEVELS = 32
STEP = 0.25  # of the logarithm to base 2, in the histogram
ROUNDS = 60

BLOCKS = "blk long, ids array<long>, flags binary, sizes binary, text binary, tokens long, train_tokens long, tune_tokens long"
SENT = "kind int, bucket long, blk long, keys binary, train binary, tune binary"
REPLY = "kind int, bucket long, blk long, train binary, tune binary, distinct long"
KEPT = "ids array<long>, flags binary, counts binary, known binary, base binary, c1 binary, c2 binary, d1 binary, d2 binary"
HISTOGRAM = "level int, r2 int, r1 int, n long"
SCORE = "doc_id long, train boolean, n_tokens long, n_known long, base_log double, score double"


def squeezed(array: np.ndarray) -> bytes:
    raw = array.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True) if raw else b""


def spread(data: bytes, kind) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), dtype=kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences in byte planes; the first byte is the number of planes."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :width] = planes.T
    return np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte per count; counts of 255 and more follow with their places."""
    large = np.flatnonzero(counts >= 255).astype(np.uint32)
    parts = np.array([len(large)], np.uint32), large, counts[large].astype(np.uint64), np.minimum(counts, 255).astype(np.uint8)
    return b"".join(p.tobytes() for p in parts)


def unpack_counts(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    counts = np.frombuffer(data, np.uint8, offset=4 + 12 * n).astype(np.int64)
    counts[np.frombuffer(data, np.uint32, n, 4)] = np.frombuffer(data, np.uint64, n, 4 + 4 * n)
    return counts


def hashes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, where each text's words begin), a few megabytes of text at a time."""
    found, first, total = [], [np.zeros(1, np.int64)], 0
    for part in portions(iter([pa.RecordBatch.from_arrays([text], names=["text"])]), most=1 << 21):
        words = find_words(part.column("text"))
        found.append(words.hash)
        first.append(words.first[1:] + total)
        total += len(words.hash)
    return np.concatenate(found or [np.zeros(0, np.uint64)]), np.concatenate(first)


def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive documents of a partition, up to BLOCK_BYTES of text (a longer text is a block alone)."""
    part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

    def block(parts):
        nonlocal made
        ids = pa.concat_arrays([p.column("doc_id") for p in parts])
        text = pa.concat_arrays([p.column("text").cast(pa.large_string()) for p in parts])
        train = np.concatenate([p.column("train").to_numpy(zero_copy_only=False) for p in parts]).astype(np.uint8)
        tune = np.concatenate([p.column("tune").to_numpy(zero_copy_only=False) for p in parts]).astype(np.uint8)
        texts = [x.encode("utf-8") for x in text.to_pylist()]
        counts = np.diff(hashes_of(text)[1]) + 1
        row = [
            pa.array([part * (1 << 32) + made], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([squeezed(train + 2 * tune)], pa.binary()),
            pa.array([squeezed(np.array([len(x) for x in texts], np.int64))], pa.binary()),
            pa.array([squeezed(np.frombuffer(b"".join(texts), np.uint8))], pa.binary()),
            *(pa.array([int(x)], pa.int64()) for x in (counts.sum(), counts[train > 0].sum(), counts[tune > 0].sum())),
        ]
        made += 1
        return pa.RecordBatch.from_arrays(row, names=[c.split()[0] for c in BLOCKS.split(", ")])

    for portion in portions(batches):
        if held and size + portion.column("text").nbytes > BLOCK_BYTES:
            yield block(held)
            held, size = [], 0
        held.append(portion)
        size += portion.column("text").nbytes
    if held:
        yield block(held)


class Block:
    """Tokens of a block: distinct words and pairs, sorted, and each token's place among them."""

    def __init__(self, row: dict):
        self.ids, flags = row["ids"], spread(row["flags"], np.uint8)
        self.train, self.tune = flags & 1 > 0, flags & 2 > 0
        sizes = spread(row["sizes"], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = spread(row["text"], np.uint8)
        text = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
        hashes, starts = hashes_of(text)
        # Each document's words and then its end; the end is also the context of a document's first token.
        self.first = starts + np.arange(len(starts))
        tokens = np.full(self.first[-1], END, dtype=np.uint64)
        own = np.ones(len(tokens), dtype=bool)
        own[self.first[1:] - 1] = False
        tokens[own] = hashes
        before = np.empty_like(tokens)
        before[1:], before[0] = tokens[:-1], END
        self.words, self.word = np.unique(tokens, return_inverse=True)
        self.pairs, self.pair = np.unique(mixed(before * np.uint64(0x2545F4914F6CDD1D) + tokens), return_inverse=True)

    def counts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each distinct word and pair stands in the chosen documents."""
        take = np.repeat(chosen, np.diff(self.first))
        return (
            np.bincount(self.word[take], minlength=len(self.words)),
            np.bincount(self.pair[take], minlength=len(self.pairs)),
        )


def edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of the hash range begins among sorted keys."""
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(keys, starts), len(keys))


def send(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, out = Block(row), []
                train, tune = block.counts(block.train), block.counts(block.tune)
                for kind, keys in enumerate((block.words, block.pairs)):
                    at = edges(keys, bits)
                    short = (keys << np.uint64(bits)) >> np.uint64(64 - 8 * KEY_BYTES[kind])
                    for b in np.flatnonzero(np.diff(at)).tolist():
                        low, high = at[b], at[b + 1]
                        out.append(
                            (kind, b, row["blk"], pack_keys(short[low:high]), pack_counts(train[kind][low:high]), pack_counts(tune[kind][low:high]))
                        )
                yield _rows(out, SENT)

    return run


def _rows(rows: list, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def add_up(table: pa.Table) -> pa.Table:
    """All blocks' counts of one bucket, added up by key; each block gets the totals of its own keys back."""
    rows = table.to_pylist()
    keys = [unpack_keys(r["keys"]) for r in rows]
    sizes = [len(k) for k in keys]
    known, back = np.unique(np.concatenate(keys), return_inverse=True)
    totals = [
        np.bincount(back, np.concatenate([unpack_counts(r[c]) for r in rows]), len(known)).astype(np.int64) for c in ("train", "tune")
    ]
    stops = np.cumsum(sizes)
    out, distinct = [], int((totals[0] > 0).sum())
    for r, size, stop in zip(rows, sizes, stops):
        train, tune = (t[back[stop - size : stop]] for t in totals)
        packed = (squeezed(np.frombuffer(pack_counts(t), np.uint8)) for t in (train, tune))
        out.append((r["kind"], r["bucket"], r["blk"], *packed, distinct))
        distinct = 0
    return pa.Table.from_batches([_rows(out, REPLY)])


def look_up(bits: int):
    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        by_place = {(r["kind"], r["bucket"]): r for r in replies.select(["kind", "bucket", "train", "tune"]).to_pylist()}
        out = []
        for row in blocks.to_pylist():
            block = Block(row)
            totals = []
            for kind, keys in enumerate((block.words, block.pairs)):
                filled = np.flatnonzero(np.diff(edges(keys, bits))).tolist()
                for c in ("train", "tune"):
                    totals.append(np.concatenate([unpack_counts(spread(by_place[kind, b][c], np.uint8).tobytes()) for b in filled]))
            c1, c2 = totals[0][block.word], totals[2][block.pair]
            tuning = np.repeat(block.tune, np.diff(block.first))
            d1, d2 = (c1 - totals[1][block.word])[tuning], (c2 - totals[3][block.pair])[tuning]
            sizes = np.diff(block.first)
            known = np.add.reduceat(c1 > 0, block.first[:-1], dtype=np.int64)
            base = np.add.reduceat(np.log10(c1 + 1.0), block.first[:-1])
            flags = spread(row["flags"], np.uint8)
            packed = [squeezed(x) for x in (flags, sizes, known, base)]
            packed += [planes(x) for x in (c1, c2, d1, d2)]
            ids = pa.array([row["ids"]], pa.list_(pa.int64()))
            out.append(pa.RecordBatch.from_arrays([ids, *(pa.array([x], pa.binary()) for x in packed)], names=[c.split()[0] for c in KEPT.split(", ")]))
        return pa.Table.from_batches(out) if out else _none()

    return run


def _none() -> pa.Table:
    names = [c.split()[0] for c in KEPT.split(", ")]
    return pa.table({n: pa.array([], pa.list_(pa.int64()) if n == "ids" else pa.binary()) for n in names})


def contexts(c1: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Count of each token's context: the token before, or the end for a document's first token."""
    first = np.cumsum(sizes) - sizes
    before = np.empty_like(c1)
    before[1:] = c1[:-1]
    before[first] = c1[first + sizes - 1]
    return before


def level_of(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(np.float64))[1], LEVELS - 1)


def planes(counts: np.ndarray) -> bytes:
    """Counts by byte planes, which compress well, as high bytes are mostly zero."""
    return squeezed(counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.copy())


def counts_of(packed: bytes) -> np.ndarray:
    raw = spread(packed, np.uint8)
    return raw.reshape(8, -1).T.copy().view(np.int64).ravel() if len(raw) else np.zeros(0, np.int64)


def histogram(n: int, v: int):
    """Tuning tokens by level and by the quantised logarithms of both estimates against the uniform one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                sizes = spread(row["counts"], np.int64)[spread(row["flags"], np.uint8) & 2 > 0]
                if not len(sizes):
                    continue
                d1, d2 = counts_of(row["d1"]), counts_of(row["d2"])
                context = contexts(d1, sizes)
                with np.errstate(divide="ignore", invalid="ignore"):
                    r2 = np.where(d2 > 0, np.round(np.log2(d2 / context * (v + 1.0)) / STEP), -9999)
                    r1 = np.where(d1 > 0, np.round(np.log2(d1 / n * (v + 1.0)) / STEP), -9999)
                keys, many = np.unique(np.stack([level_of(context), r2, r1]).astype(np.int64), axis=1, return_counts=True)
                for key, count in zip(keys.T.tolist(), many.tolist()):
                    cells[tuple(key)] = cells.get(tuple(key), 0) + count
        yield _rows([(*key, count) for key, count in cells.items()], HISTOGRAM)

    return run


def learn(cells: list[tuple[int, int, int, int]]) -> np.ndarray:
    """(LEVELS, 3) weights of pair, word and uniform estimates, by expectation-maximisation per level."""
    weights = np.full((LEVELS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5  # an unseen context has no pairs
    if not cells:
        return weights
    level, r2, r1, n = (np.array(c) for c in zip(*cells))
    ratios = np.stack([np.where(r2 > -9999, 2.0 ** (r2 * STEP), 0.0), np.where(r1 > -9999, 2.0 ** (r1 * STEP), 0.0), np.ones(len(n))])
    for _ in range(ROUNDS):
        parts = weights[level].T * ratios
        parts *= n / parts.sum(axis=0)
        sums = np.stack([np.bincount(level, p, LEVELS) for p in parts], axis=1)
        # A thousandth of a token each, so that no estimate is ever ruled out.
        sums += 1e-3 * (weights > 0)
        weights = sums / sums.sum(axis=1, keepdims=True)
    return weights


def score(n: int, v: int, weights: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(weights)
        for batch in batches:
            for row in batch.to_pylist():
                flags, sizes = spread(row["flags"], np.uint8), spread(row["counts"], np.int64)
                c1, c2 = counts_of(row["c1"]), counts_of(row["c2"])
                context = contexts(c1, sizes)
                w = table[level_of(context)]
                p = w[:, 0] * c2 / np.maximum(context, 1) + w[:, 1] * c1 / max(n, 1) + w[:, 2] / (v + 1)
                sums = np.add.reduceat(np.log10(p), np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], pa.int64()),
                        pa.array(flags & 1 > 0),
                        pa.array(sizes),
                        pa.array(spread(row["known"], np.int64)),
                        pa.array(spread(row["base"], np.float64)),
                        pa.array(sums),
                    ],
                    names=[c.split()[0] for c in SCORE.split(", ")],
                )

    return run


def lm_scores(docs: DataFrame, train: Column, tune: Column) -> DataFrame:
    """One row per document: doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    `train` names the documents that are learned from, `tune` those of them that the weights are fitted on. Tokens are
    words, A-Z lower-cased, and one end per document. A null or empty text is its end alone. `base_score` is the add-one
    unigram, `score` the model. With no training documents all counts are 0 and the scores those of unseen tokens. Null ids and
    repeated rows are passed on as they are; other columns are ignored; an empty frame gives none.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.coalesce(train & tune, F.lit(False)).alias("tune"),
    )
    blocks = written(source.mapInArrow(to_blocks, BLOCKS), "blocks")
    size = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "train_tokens", "tune_tokens"))).first()
    bits = max(0, int(np.ceil(np.log2(max(1, size.tokens / BUCKET_KEYS)))))
    sent = blocks.mapInArrow(send(bits), SENT)
    replies = written(sent.groupBy("kind", "bucket").applyInArrow(add_up, REPLY), "replies")
    distinct = replies.where("kind = 0").agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first().v
    counted = blocks.groupBy("blk").cogroup(replies.drop("distinct").groupBy("blk")).applyInArrow(look_up(bits), KEPT)
    kept = written(counted, "counts")
    cells = (
        kept.select("flags", "counts", "d1", "d2")
        .mapInArrow(histogram(max(1, size.train_tokens - size.tune_tokens), distinct), HISTOGRAM)
        .groupBy("level", "r2", "r1")
        .agg(F.sum("n").alias("n"))
        .orderBy("level", "r2", "r1")
        .collect()
    )
    weights = learn([tuple(c) for c in cells])
    rows = kept.drop("d1", "d2").mapInArrow(score(size.train_tokens, distinct, weights.tolist()), SCORE)
    down = float(np.log10(size.train_tokens + distinct + 1.0))
    return rows.select(
        "doc_id",
        "train",
        "n_tokens",
        "n_known",
        F.lit(size.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_log") - F.col("n_tokens") * down).alias("base_score"),
        "score",
    )
