"""Words of whole text columns as 64-bit hashes, made with numpy straight from Arrow's buffers.

A word is a run of bytes other than the six blanks; UTF-8 letters never hold those bytes. The hash of a word is a
polynomial in an odd random base over random 64-bit values of its bytes, taken as a difference of prefix sums
and mixed. The same word has the same hash everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_random = np.random.default_rng(20240229)
_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
#: Hash of the end of a text; no word has it but by chance.
END = np.uint64(0xD1B54A32D192ED03)

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, count: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < count:
        steps = np.full(max(count, 1 << 20), base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if count <= 1 << 22:  # longer texts are rare: their powers are not kept
            _powers[name] = have
    return have[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result hangs on every bit of the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a run of texts: `hash` of each, `first[i]:first[i + 1]` those of text i, `start` and `end` in `data`."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hash[self.first[i] : self.first[i + 1]]

    def text(self, k: int) -> str:
        return self.data[self.start[k] : self.end[k]].tobytes().decode("utf-8", "replace")


def find_words(text: pa.Array, fold: bool = True) -> Words:
    """Words of each text (null: none). `fold`: A-Z hash as a-z."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    buffer = text.buffers()[2]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(text) else (0, 0)
    data = np.frombuffer(buffer, dtype=np.uint8)[low:high] if buffer is not None and high > low else np.zeros(0, np.uint8)
    offsets = (offsets - low) if len(text) else np.zeros(1, np.int64)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(text) + 1, np.int64), none, none, data)
    blank = _BLANK[data]
    opens, closes = np.empty(len(data), bool), np.empty(len(data), bool)
    opens[0] = closes[-1] = True
    opens[1:] = blank[:-1]
    closes[:-1] = blank[1:]
    filled = offsets[1:] > offsets[:-1]
    opens[offsets[:-1][filled]] = True
    closes[offsets[1:][filled] - 1] = True
    start, end = np.flatnonzero(opens & ~blank), np.flatnonzero(closes & ~blank) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_FOLDED if fold else _VALUES)[data] * _power("up", _BASE, len(data)), out=sums[1:])
    hashes = mixed((sums[end] - sums[start]) * _power("down", _INVERSE, len(data))[start])
    return Words(hashes, np.searchsorted(start, offsets), start, end, data)


def portions(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a portion's texts have at most `most` bytes; a longer text is a portion of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, at = np.cumsum(size), 0
        while at < len(size):
            before = total[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of all runs of n words, sorted; fewer words are one shingle as a whole; no words, no shingle."""
    if not len(words):
        return words[:0]
    width = min(n, len(words))
    total = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        total = mixed(total * np.uint64(0x2545F4914F6CDD1D) + words[k : len(words) - width + 1 + k])
    if width < n:  # a whole short sequence is no shingle of full length
        total = mixed(total + np.uint64(width))
    return np.unique(total)
