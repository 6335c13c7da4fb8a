"""Harmonic packing of token sequences.

Documents are cut into pieces whose lengths are reciprocal shares of the capacity: 4096, then 2048, 1024 ... 64 by
the binary digits of the rest, and a tail of less than 64 tokens. Each length is a class, and each bin of a class takes
a fixed number of pieces: capacity // length. Every task numbers the pieces of its own partition per class; running
sums of the tasks' counts turn these into numbers per class, and number and class alone give bin and offset, with no
search for room and no order between workers. A class leaves at most one bin unfilled; the pieces of these, fewer than
20,000 in all whatever the input's size, are filled up one after the other, long ones first.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.words import find_words, portions
from eventmart.llm.worker import held, tidy
from eventmart.session import written

CAPACITY = 4096
LEAST = 64
END_ID = 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
#: Words kept with their ids per Python worker; the store starts anew when it is full.
KEPT_WORDS = 1_000_000
# Letters of ASCII and Latin-1 in UTF-8, whose lower case and composed form are plain, then closing marks.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([,.;:!?]*)")


def pieces_of(total: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of the pieces of a document of `total` tokens: full bins, halves by binary digits, a tail."""
    lengths, rest, size = [capacity] * (total // capacity), total % capacity, capacity // 2
    while size >= least:
        if rest & size:
            lengths.append(size)
        size //= 2
    tail = rest % least
    return lengths + [tail] * (tail > 0)


class WordIds:
    """Token ids of words by a tokenizer whose tokens never cross white space; each distinct word is tokenized once.

    A word of plain letters, with closing marks or none, goes to the tokenizer's model alone, letters and marks as the two
    parts that its splitting rule makes of them; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.forget()
        # The byte alphabet of byte-level models: printable bytes stand for themselves, others from code point 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.tails: dict[bytes, list[int]] = {}
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def forget(self) -> None:
        # Sorted hashes with their places; the ids of place k are flat[edges[k] : edges[k + 1]].
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.edges = array("I"), array("q", [0])

    def encode(self, word: bytes) -> list[int]:
        plain = _PLAIN.fullmatch(word)
        if plain is None:
            return self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        body, tail = plain.groups()
        if body.isascii():
            letters = body.lower().decode("ascii")
        else:
            letters = body.decode("utf-8").lower().encode("utf-8").decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(letters)]
        if tail:
            if tail not in self.tails:
                self.tails[tail] = [t.id for t in self.model.tokenize(tail.decode("ascii"))]
            ids += self.tails[tail]
        return ids

    def documents(self, text: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text."""
        words = find_words(text, fold=False)
        known, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.known) + len(known) > KEPT_WORDS:
            self.forget()
        at = np.searchsorted(self.known, known)
        new = np.ones(len(known), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != known[inside]
        raw, fresh = words.data.tobytes(), first[new]
        for low, high in zip(words.start[fresh].tolist(), words.end[fresh].tolist()):
            self.flat.extend(self.encode(raw[low:high]))
            self.edges.append(len(self.flat))
        self.place = np.insert(self.place, at[new], len(self.known) + np.arange(len(fresh)))
        self.known = np.insert(self.known, at[new], known[new])
        places = self.place[np.searchsorted(self.known, known)][back]
        # Copies, as the stores cannot grow while numpy looks into them.
        flat, edges = np.array(self.flat, dtype=np.uint32), np.array(self.edges, dtype=np.int64)
        starts, size = edges[places], edges[places + 1] - edges[places]
        ends = np.cumsum(size)
        # Position by position: where the word's ids begin in the store, less where its own begin in the output.
        ids = flat[np.repeat(starts - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[words.first]
        for low, high in zip(bounds[:-1], bounds[1:]):
            yield ids[low:high]


def cut(path: str, capacity: int, least: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = held(("ids", path), lambda: WordIds(path))
        part, counts = TaskContext.get().partitionId(), {}
        for batch in portions(batches):
            ids, start, length, crc, tokens, nth = [], [], [], [], [], []
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), store.documents(batch.column("text"))):
                own, at = np.append(own, np.uint32(end_id)).astype("<u4"), 0
                for size in pieces_of(len(own), capacity, least):
                    ids.append(doc_id)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(own[at : at + size].tobytes()))
                    tokens.append(len(own))
                    nth.append(counts.get(size, 0))
                    counts[size] = nth[-1] + 1
                    at += size
            columns = [pa.array(c, pa.int64()) for c in (ids, start, length, crc, tokens)]
            columns += [pa.array([part] * len(ids), pa.int32()), pa.array(nth, pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return tidy(run, keep=True)


def fill_rest(capacity: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        """One after the other, long pieces first; a new bin whenever the next piece does not fit."""
        pieces = pieces.sort_values(["length", "number"], ascending=[False, True], kind="stable")
        bins, offsets, bin_, used = [], [], 0, 0
        for size in pieces["length"].tolist():
            if used + size > capacity:
                bin_, used = bin_ + 1, 0
            bins.append(bin_)
            offsets.append(used)
            used += size
        return pieces.assign(bin=bins, offset=offsets)[["length", "number", "bin", "offset"]]

    return run


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, least: int = LEAST, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text (null: empty) and `end_id`; each lies in exactly one piece. `doc_id` is passed
    on as it is, null and repeated ones too: rows are told apart by nothing else, so repeated rows give repeated
    pieces in places of their own. Other columns are ignored. An empty frame gives none. `capacity` must be a power of
    two. Sequences are numbered without gaps within the full bins of each class, those of the filled-up rest coming last.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Written once: tokens are made once, and a task that is repeated elsewhere finds its numbers as they were.
    pieces = written(source.mapInArrow(cut(tokenizer, capacity, least, end_id), PIECES), "pieces")
    counts = pieces.groupBy("length", "part").agg((F.max("nth") + 1).alias("own"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("first"))
    # At most capacity // 64 + 7 classes: their counts are a small, bounded table.
    totals = counts.groupBy("length").agg(F.sum("own").alias("n")).collect()
    classes, base = [], 0
    for row in sorted(totals, key=lambda row: -row.length):
        fit = capacity // row.length
        classes.append((row.length, fit, row.n // fit * fit, base))
        base += row.n // fit
    kind = "length long, fit long, full long, base long"
    table = F.broadcast(spark.createDataFrame(classes, kind))
    numbered = (
        pieces.join(firsts, ["length", "part"])
        .withColumn("number", F.col("nth") + F.col("first"))
        .join(table, "length")
        .drop("nth", "part", "first")
    )
    rest = (
        numbered.where("number >= full")
        .select("length", "number")
        .groupBy()
        .applyInPandas(fill_rest(capacity), "length long, number long, bin long, offset long")
    )
    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    full = (
        numbered.where("number < full")
        .withColumn("sequence_id", F.col("base") + F.floor(F.col("number") / F.col("fit")))
        .withColumn("offset", F.col("number") % F.col("fit") * F.col("length"))
    )
    filled = (
        numbered.where("number >= full").join(rest, ["length", "number"]).withColumn("sequence_id", F.lit(base) + F.col("bin"))
    )
    return full.select(*result).unionByName(filled.select(*result))
