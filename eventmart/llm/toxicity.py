"""Toxicity of whole texts by a subsequence string-kernel support vector machine with Nystroem landmarks.

Kernel of two words: the weighted number of common subsequences of four letters, gaps included, over spans of up to seven
letters; each letter of span costs a factor of `DECAY`, and the sum is divided by
the roots of both words' kernels with themselves.
An insult with letters put in, left out or swapped for signs keeps most of its subsequences. Signs between letters are
passed over, digits that stand for letters are read as these, and runs of single letters are read as one word as well.

Machine: the kernel against `landmarks` words, whitened by the landmarks' own kernel matrix (Nystroem), and a linear SVM
with squared hinge loss. As the kernel is linear in the subsequences, the trained machine folds into one weight per
subsequence of its landmarks, and a word's margin is a sum of looked-up weights. Training is on labelled sentences, of which only the text's label is known: in a toxic
text at least one sentence, by at least one word, is toxic (multiple instances). Each round takes as positive the
best words of the best sentences of each toxic text, never words that clean texts have, and as negative words of clean
texts, the hardest among them.
A text's margin is that of its best sentence, that of a sentence its best word; a logistic curve turns it into a score.

The fit takes a bounded sample of labelled texts (`PER_LABEL` of each label, of at most `LONGEST` characters), as it may. Every
text is scored whole. Each distinct word is judged once per Python worker, from a store of bounded size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.words import Words, find_words, portions
from eventmart.llm.worker import give_back, held, tidy

PER_LABEL = 1200
LONGEST = 20_000
LANDMARKS = 192
DECAY = 0.7
LETTERS, SPAN = 4, 7
WIDTH = 18  # letters of a word read at once, with its two marks; longer words are read in windows
ALPHABET = 48
ROUNDS = 3
NEGATIVES = 20_000
HARDEST = 500
KEPT_WORDS = 1_000_000
CHUNK = 1024  # rows of windows worked on at once
# Evidence (see first_guess) that a word must have to count as the reason for a toxic label. Texts without such a word are
# taken as wrongly labelled: a piece in four toxic texts and no clean one has more, one of a single text or two less.
EVIDENCE = 12.0
# A piece must be so much likelier in toxic texts (logarithm) to be evidence at all.
LEAST_ODDS = 2.5
_PATTERNS = [(0, *rest) for rest in combinations(range(1, SPAN), LETTERS - 1)]
# Digits and signs that stand for letters.
_STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_OPEN, _CLOSE, _BREAK = 1, 2, 255
_SENTENCE = re.compile(r"[^.!?\n]+")


def _hashed(points: np.ndarray) -> np.ndarray:
    """Codes from 30 on for letters other than a to z, spread so that neighbours in a script differ."""
    return (30 + (points * np.uint64(2654435761) >> np.uint64(12)) % np.uint64(ALPHABET - 30)).astype(np.uint8)


def _letter_codes() -> np.ndarray:
    """Code of each code point below 0x3040: 0 for signs, 3 to 28 for a to z, 29 for other digits, hashed codes for other letters."""
    codes = np.zeros(0x3040, dtype=np.uint8)
    for point in range(len(codes)):
        ch = chr(point)
        ch = _STANDS_FOR.get(ch, ch)
        if "a" <= ch <= "z":
            codes[point] = 3 + ord(ch) - 97
        elif ch.isdigit():
            codes[point] = 29
        elif ch.isalpha():
            codes[point] = _hashed(np.uint64(point))
    codes[10] = _BREAK
    return codes


_CODES = _letter_codes()


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows of letter codes, the word that each window is of). A word without four letters has no window."""
    text = b"\n".join(words).decode("utf-8", "replace").lower()
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    codes = _CODES[np.minimum(points, len(_CODES) - 1)]
    # Beyond the table: letters, but for private use, full-width marks and pictures.
    far = np.flatnonzero(points >= len(_CODES))
    if len(far):
        high = points[far].astype(np.uint64)
        marks = (high >= 0xE000) & (high < 0xF900) | (high >= 0xFE00) & (high < 0xFF21) | (high >= 0x1F000) & (high < 0x20000) | (high >= 0xE0000)
        codes[far] = np.where(marks, 0, _hashed(high))
    # Marks at the edges of a word are punctuation, not letters in disguise.
    breaks = codes == _BREAK
    word = np.cumsum(breaks)
    for edge in "!$@":
        sign = points == ord(edge)
        before, after = np.append(True, breaks[:-1]), np.append(breaks[1:], True)
        codes[sign & (before | after)] = 0
    keep = (codes > 0) & ~breaks
    codes, word = codes[keep], word[keep]
    sizes = np.bincount(word, minlength=len(words))
    firsts = np.cumsum(sizes) - sizes
    body = WIDTH - 2
    step = body // 2
    windows = np.where(sizes >= LETTERS - 1, 1 + np.maximum(0, -(-(sizes - body) // step)), 0)
    of = np.repeat(np.arange(len(words)), windows)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    # The last window of a long word ends with the word.
    start = np.minimum(nth * step, np.maximum(sizes[of] - body, 0))
    length = np.minimum(sizes[of], body)
    place = np.arange(body)[None, :]
    inside = place < length[:, None]
    found = np.zeros((len(of), WIDTH), dtype=np.uint8)
    if len(of):
        take = np.minimum(firsts[of][:, None] + start[:, None] + place, len(codes) - 1)
        found[:, 1:-1] = np.where(inside, codes[take], 0)
        found[start == 0, 0] = _OPEN
        ends = np.flatnonzero(start + length == sizes[of])
        found[ends, 1 + length[ends]] = _CLOSE
    return found, of


def subsequences(windows: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """(weight, code of the subsequence at this place of each window), for all places and patterns.

    Codes with a missing letter are those of no subsequence of a landmark.
    """
    wide = np.ascontiguousarray(windows.T.astype(np.int32))
    pairs = {(i, j): wide[i] * ALPHABET + wide[j] for i in range(WIDTH) for j in range(i + 1, min(WIDTH, i + SPAN))}
    for a, b, c, d in _PATTERNS:
        weight = DECAY ** (d + 1)
        for at in range(WIDTH - d):
            yield weight, pairs[at + a, at + b] * ALPHABET**2 + pairs[at + c, at + d]


def complete(codes: np.ndarray) -> np.ndarray:
    """Which codes have all four letters."""
    return (codes % ALPHABET > 0) & (codes // ALPHABET % ALPHABET > 0) & (codes // ALPHABET**2 % ALPHABET > 0) & (codes // ALPHABET**3 > 0)


def norms(windows: np.ndarray) -> np.ndarray:
    """Root of each window's kernel with itself. Equal subsequences of one word count together."""
    parts = [_norms(windows[at : at + CHUNK]) for at in range(0, len(windows), CHUNK)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.float32)


def _norms(windows: np.ndarray) -> np.ndarray:
    weights = sorted({DECAY ** (p[-1] + 1) for p in _PATTERNS})
    level = {w: i for i, w in enumerate(weights)}
    found = np.stack([np.where(complete(codes), codes * len(weights) + level[w], 0) for w, codes in subsequences(windows)], axis=1)
    found.sort(axis=1)
    opens = np.ones(found.shape, dtype=bool)
    opens[:, 1:] = found[:, 1:] // len(weights) != found[:, :-1] // len(weights)
    value = np.array(weights)[found % len(weights)] * (found > 0)
    firsts = np.flatnonzero(opens.ravel())
    sums = np.add.reduceat(value.ravel(), firsts) ** 2
    total = np.bincount(firsts // found.shape[1], sums, len(windows))
    return np.sqrt(np.maximum(total, 1e-9)).astype(np.float32)


class Landmarks:
    """The normalised kernel of words with a list of landmark words."""

    def __init__(self, words: list[bytes]):
        windows, of = spelled(words)
        first = np.unique(of, return_index=True)[1]
        self.windows = windows[first]
        table: dict[int, dict[int, float]] = {}
        for weight, codes in subsequences(self.windows):
            for j in np.flatnonzero(complete(codes)).tolist():
                row = table.setdefault(int(codes[j]), {})
                row[j] = row.get(j, 0.0) + weight
        self.place = np.full(ALPHABET**LETTERS, -1, dtype=np.int32)
        self.rows = np.zeros((len(table), len(self.windows)), dtype=np.float32)
        for k, (code, row) in enumerate(table.items()):
            self.place[code] = k
            for j, value in row.items():
                self.rows[k, j] = value
        self.rows /= norms(self.windows)

    def kernel(self, windows: np.ndarray) -> np.ndarray:
        found = np.zeros((len(windows), self.rows.shape[1]), dtype=np.float32)
        for at in range(0, len(windows), CHUNK):
            part, own = windows[at : at + CHUNK], found[at : at + CHUNK]
            for weight, codes in subsequences(part):
                places = self.place[codes]
                hit = np.flatnonzero(places >= 0)
                if len(hit):
                    own[hit] += np.float32(weight) * self.rows[places[hit]]
            own /= norms(part)[:, None]
        return found

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """One weight per subsequence: the landmarks' rows, weighted and added."""
        table = np.zeros(ALPHABET**LETTERS, dtype=np.float32)
        filled = np.flatnonzero(self.place >= 0)
        table[filled] = self.rows[self.place[filled]] @ weights.astype(np.float32)
        return table


def word_margins(words: list[bytes], table: np.ndarray, bias: float) -> np.ndarray:
    """Margin of each word: of its best window, or the bias if it has none."""
    best = np.full(len(words), bias)
    for first in range(0, len(words), 8192):
        windows, of = spelled(words[first : first + 8192])
        for at in range(0, len(windows), 8192):
            part = windows[at : at + 8192]
            total = np.zeros(len(part), dtype=np.float32)
            for weight, codes in subsequences(part):
                total += np.float32(weight) * table[codes]
            np.maximum.at(best, first + of[at : at + 8192], total / norms(part) + bias)
    return best


@dataclass(frozen=True)
class Model:
    landmarks: tuple[bytes, ...]
    weights: tuple[float, ...]
    bias: float
    slope: float
    shift: float

    def table(self) -> np.ndarray:
        return Landmarks(list(self.landmarks)).folded(np.array(self.weights))

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def joined_letters(words: Words) -> list[tuple[int, bytes]]:
    """(text, word) of each run of three or more words of one letter, read as one word."""
    single = (words.end - words.start == 1).astype(np.int8)
    change = np.flatnonzero(np.diff(np.concatenate([[0], single, [0]])))
    found = []
    for low, high in zip(change[::2].tolist(), change[1::2].tolist()):
        while high - low >= 3:
            text = int(np.searchsorted(words.first, low, side="right")) - 1
            stop = min(high, int(words.first[text + 1]))
            if stop - low >= 3:
                found.append((text, b"".join(words.data[words.start[k] : words.end[k]].tobytes() for k in range(low, stop))))
            low = max(stop, low + 1)
    return found


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, by Newton steps on the rows within the margin."""
    size = x.shape[1] + 1
    keep = np.eye(size)
    keep[-1, -1] = 1e-6
    w, active = np.zeros(size), np.ones(len(y), dtype=bool)
    for _ in range(steps):
        left, right, now = keep.copy(), np.zeros(size), np.zeros(len(y), dtype=bool)
        for at in range(0, len(y), CHUNK):
            some = at + np.flatnonzero(active[at : at + CHUNK])
            part = np.hstack([x[some], np.ones((len(some), 1))]).astype(np.float64)
            weighted = part * cost[some][:, None]
            left += weighted.T @ part
            right += weighted.T @ y[some]
        w = np.linalg.solve(left, right)
        for at in range(0, len(y), CHUNK):
            now[at : at + CHUNK] = y[at : at + CHUNK] * (x[at : at + CHUNK] @ w[:-1] + w[-1]) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def first_guess(toxic: list[list[bytes]], clean: list[list[bytes]]) -> dict[bytes, float]:
    """Words of toxic texts by the evidence of their beginnings and four-letter pieces: in how many toxic texts, how few clean ones."""

    def pieces(word: bytes) -> set[bytes]:
        word = b"^" + word.strip(b".,;:!?\"'()").lower()
        inner = {word[i : i + 4] for i in range(max(1, len(word) - 3))}
        return inner | {word[:n] for n in range(5, min(len(word), 9) + 1)}

    counts = [Counter(p for words in texts for p in {p for w in set(words) for p in pieces(w)}) for texts in (toxic, clean)]
    rates = [1 / (len(texts) + 1) for texts in (toxic, clean)]

    def evidence(p: bytes) -> float:
        """How much likelier the toxic texts with this piece are at their own rate than at that of clean texts."""
        a, b = ((counts[k][p] + 0.5) * rates[k] for k in (0, 1))
        odds = float(np.log(a / b))
        return counts[0][p] * odds if odds >= LEAST_ODDS else 0.0

    return {w: max(map(evidence, pieces(w))) for words in toxic for w in set(words)}


def spread_out(ranked: list[bytes], most: int, limit: float = 0.5) -> list[bytes]:
    """The first words in order that are not too like one another."""
    windows, of = spelled(ranked)
    first = np.unique(of, return_index=True)
    chosen: list[int] = []
    if not len(first[0]):
        return []
    machine = Landmarks([ranked[i] for i in first[0]])
    near = machine.kernel(machine.windows)
    for i in range(len(first[0])):
        if len(chosen) < most and (not chosen or near[i, chosen].max() < limit):
            chosen.append(i)
    return [ranked[first[0][i]] for i in chosen]


def fit(texts: list[tuple[str, int]], landmarks: int = LANDMARKS) -> Model:
    """The machine from labelled texts. Without both labels it gives every text the share of toxic ones."""
    bags = [[] for _ in range(2)]
    same: dict[bytes, bytes] = {}  # one object per word
    for text, label in sorted(set(texts)):
        # Distinct words by sentence; sentences of a clean text are all clean, one of a toxic text is not.
        split = (dict.fromkeys(s.encode().split()) for s in _SENTENCE.findall(text))
        sentences = [[same.setdefault(w, w) for w in words] for words in split if words]
        if sentences:
            bags[label].append(sentences)
    share = len(bags[1]) / max(1, len(bags[0]) + len(bags[1]))
    if not bags[0] or not bags[1]:
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Model((b"none",), (0.0,), 0.0, 0.0, float(odds))
    flat = [[[w for s in bag for w in s] for bag in side] for side in bags]
    clean_words = sorted({w for words in flat[0] for w in words})
    guess = first_guess(flat[1], flat[0])
    # A word that clean texts have as well is a clean word; only the others can make a sentence toxic.
    known = Counter(w for words in flat[0] for w in set(words))
    heard = Counter(w for words in flat[1] for w in set(words))
    in_clean = {w for w, n in known.items() if heard[w] * len(flat[0]) < 10 * n * len(flat[1])}
    clean_words = [w for w in clean_words if w in in_clean]
    suspects = [sorted(set(words) - in_clean, key=lambda w: (-guess[w], w)) for words in flat[1]]
    pool = sorted({w for words in suspects for w in words})
    random = np.random.default_rng(11)
    told = [words for words in suspects if words and guess[words[0]] >= EVIDENCE] or [words for words in suspects if words]
    # Landmarks on the toxic side: words that are among the three best of most texts.
    leading = Counter(w for words in told for w in words[:3])
    ranked = sorted(leading, key=lambda w: (-leading[w], -guess[w], w))
    chosen = spread_out(ranked[: 4 * landmarks], landmarks // 2, 0.7)
    common = [clean_words[i] for i in random.permutation(len(clean_words))[: 2 * landmarks]]
    chosen += spread_out(common, landmarks // 4)
    hard: list[bytes] = []
    worst: list[bytes] = []
    witnesses = [words[0] for words in told]
    for _ in range(ROUNDS):
        words = list(dict.fromkeys(chosen + hard))
        machine = Landmarks(words)
        gram = machine.kernel(machine.windows).astype(np.float64)
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        whiten = vectors / np.sqrt(np.maximum(values, 1e-2 * values.max())) @ vectors.T
        negative = [clean_words[i] for i in random.permutation(len(clean_words))[:NEGATIVES]]
        rows, y, cost = [], [], []
        for label, weight, side in ((1.0, 10.0, witnesses), (-1.0, 10.0, worst), (-1.0, 1.0, negative)):
            windows, of = spelled(side)
            kernel = machine.kernel(windows)
            # A long word stands for itself by its window nearest to any landmark.
            order = np.lexsort((-kernel.max(axis=1), of))
            first = order[np.unique(of[order], return_index=True)[1]]
            rows.append(kernel[first] @ whiten.astype(np.float32))
            del windows, kernel
            y += [label] * len(first)
            cost += [weight] * len(first)
        weights, bias = svm(np.vstack(rows), np.array(y), np.array(cost))
        weights = whiten @ weights
        table = machine.folded(weights)
        clean = dict(zip(clean_words, word_margins(clean_words, table, bias).tolist()))
        tops = dict(zip(pool, word_margins(pool, table, bias).tolist()))
        # Next round: the clean words that look worst, and of each toxic text its two best words.
        worst = list(dict.fromkeys(worst + sorted(clean, key=lambda w: -clean[w])[:HARDEST]))
        hard = spread_out(worst[-HARDEST:], landmarks // 4, 0.8)
        witnesses = []
        for own in told:
            best = sorted(own, key=lambda w: -tops[w])[:2]
            witnesses += [w for i, w in enumerate(best) if i == 0 or tops[w] > 0]
    table_of = clean | tops
    best = [[max((table_of[w] for w in words), default=bias) for words in side] for side in flat]
    x = np.array(best[0] + best[1])
    label = np.array([0.0] * len(best[0]) + [1.0] * len(best[1]))
    slope, shift = logistic(x, label)
    return Model(tuple(words), tuple(weights.tolist()), bias, slope, shift)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve with softened labels, by Newton steps."""
    up, down = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target, w = np.where(y > 0, up, down), np.array([1.0, 0.0])
    wide = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(wide @ w, -30, 30)))
        slope = wide.T @ (p - target) + 1e-3 * w
        curve = (wide * (p * (1 - p))[:, None]).T @ wide + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
    return float(w[0]), float(w[1])


class Judge:
    """Margins of texts; words once judged are kept, as sorted hashes, until there are too many."""

    def __init__(self, model: Model):
        self.model, self.table = model, model.table()
        self.known, self.margin = np.zeros(0, np.uint64), np.zeros(0)

    def texts(self, text: pa.Array) -> np.ndarray:
        words = find_words(text)
        hashes, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        if new.any():
            raw = words.data.tobytes()
            chosen = first[new]
            spans = zip(words.start[chosen].tolist(), words.end[chosen].tolist())
            fresh = word_margins([raw[a:b] for a, b in spans], self.table, self.model.bias)
            if len(self.known) + len(fresh) > KEPT_WORDS:
                old = ~new
                self.known, self.margin = hashes[old], self.margin[at[old]]
                at = np.searchsorted(self.known, hashes)
            self.known = np.insert(self.known, at[new], hashes[new])
            self.margin = np.insert(self.margin, at[new], fresh)
        margin = self.margin[np.searchsorted(self.known, hashes)][back]
        best = np.full(len(text), self.model.bias)
        filled = np.flatnonzero(np.diff(words.first))
        if len(filled):
            best[filled] = np.maximum(best[filled], np.maximum.reduceat(margin, words.first[filled]))
        for i, word in joined_letters(words):
            best[i] = max(best[i], word_margins([word], self.table, self.model.bias)[0])
        return best


def judge(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(("judge", model), lambda: Judge(model))
        for batch in portions(batches):
            score = own.model.probability(own.texts(batch.column("text")))
            columns = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*names, "score"])

    return tidy(run, keep=True)


def train(docs: DataFrame, labels: DataFrame, learned: Column, per_label: int = PER_LABEL, longest: int = LONGEST) -> Model:
    """A model from at most `per_label` labelled documents of each label (smallest hashes of the id) that `learned` names."""
    sample = None
    usable = labels.where(learned & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    for label in (0, 1):
        part = usable.where(F.col("toxic") == label).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        sample = part if sample is None else sample.unionByName(part)
    rows = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .where(F.col("text").isNotNull() & (F.length("text") <= longest))
        .join(F.broadcast(sample), "doc_id")  # at most two times per_label ids
        .select("text", "toxic")
        .collect()
    )
    texts = [(row.text, row.toxic) for row in rows]
    del rows
    try:
        return fit(texts)
    finally:  # the driver lives on; what the fit has freed is of no use to it
        give_back()


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document: 0 to 1. A text without words, empty or null, has the score of no evidence.

    Null ids and repeated rows are passed on as they are; other columns are ignored; an empty frame gives none.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(judge(model), "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of `docs` with a score below `limit`, all columns. Decided row by row as the texts pass, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(("judge", model), lambda: Judge(model))
        for batch in portions(batches):
            score = own.model.probability(own.texts(batch.column("text")))
            yield batch.filter(pa.array(score < limit))

    return docs.mapInArrow(tidy(run, keep=True), docs.schema)
