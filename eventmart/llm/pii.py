"""Personal data: patterns, and a skip-chain conditional random field that carries their labels through a document.

Patterns give the base spans (email, ip, card, phone). The field's nodes are the document's mentions: runs of letters, digits
and `._%+@-` that hold a digit or an at sign, and words that are the local part of one of its email addresses. A node's label
is none or one of the four kinds. Mentions that stand together are linked in a chain. Mentions that are the same or alike
somewhere else in the document (same text, same digits whatever stands between them, same local part) share a potential:
each is linked to one hub of their key, so that thousands of repeats cost as many links and no pairs. Loopy message passing
over both kinds of links gives each mention's marginals; nodes of base spans are held at their label. Mentions that end up
with a kind become additional spans.

Training is piecewise: the node factor is a logistic regression on a mention's shape, the link factors come from counts of
labels of neighbouring and of repeated mentions. All counts are over all documents, made on the executors; the driver gets one
row per shape and label (their number is bounded by the shapes, not by the documents). Labels are the patterns' own;
a mention without one that shares a key with one that has a label is unlabelled and not counted.

Cases: a null or empty text has no spans and the digest of the empty text; repeated rows are judged alike, each on its own; texts are whole,
and all scans are linear in their length; an empty table gives no row and an untrained field; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import whole_text

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0: none
ROUNDS = 12
DAMPING = 0.3
SURE = 0.5
AGREEMENT = (10.0, 0.02)  # assumed beforehand: what is repeated keeps its label

# --- Patterns ----------------------------------------------------------------------------------------------------

# The patterns of the four kinds. Repeats that can not give back anything useful are possessive.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind (from 0), start, end


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def is_card(digits: str) -> bool:
    return 16 <= len(digits) <= 19 and luhn(digits)


def is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: from an at sign back over its local part, which the address before may have used up."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[Span]:
    """Spans of all kinds, by kind and then start."""
    found = [(0, start, end) for start, end in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if is_ip(m.group())]
    found += [(2, *m.span()) for m in _CARD.finditer(text) if is_card(digits_of(m.group()))]
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return found


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans))


# --- Mentions and their shapes -----------------------------------------------------------------------------------

_TELLING = re.compile(r"[0-9@]")
_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_RUN_CHARS = _LOCAL | {"@"}
_TOGETHER = frozenset(" ().-/")


def mentions(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Mentions from left to right, without marks at their ends."""
    found, floor = [], 0
    telling = _TELLING.search(text)
    while telling:
        start = telling.start()
        while start > floor and text[start - 1] in _RUN_CHARS:
            start -= 1
        floor = _RUN.match(text, telling.start()).end()
        found.append((start, floor))
        telling = _TELLING.search(text, floor)
    locals_ = {text[s:e].split("@")[0].lower() for kind, s, e in base if kind == 0}
    locals_ = {name for name in locals_ if len(name) >= 5}
    if locals_:
        for run in _RUN.finditer(text):
            if run.group().strip(".-_%").lower() in locals_ and not _TELLING.search(run.group()):
                found.append(run.span())
    trimmed = []
    for start, end in sorted(found):
        while end - start > 1 and text[start] in ".-_%":
            start += 1
        while end - start > 1 and text[end - 1] in ".-_%+":
            end -= 1
        trimmed.append((start, end))
    return trimmed


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= edge for edge in edges)


_DIGITS = (1, 2, 3, 4, 5, 8, 10, 13, 16, 20)
_NEIGHBOUR = (1, 3, 5, 8)
# Values of each feature of a shape: digits, letters, at signs, dots, plus, hyphens, three checks, neighbours.
SIZES = (len(_DIGITS) + 1, 3, 3, 5, 2, 3, 2, 2, 2, len(_NEIGHBOUR) + 2, 2, len(_NEIGHBOUR) + 2)
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)[:-1]])


@dataclass
class Graph:
    """Mentions of any number of documents as one graph; documents are parts of it without links between them."""

    owner: list[int] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)  # of base spans; 0 elsewhere
    shapes: list[tuple[int, ...]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    keyed: list[tuple[int, int]] = field(default_factory=list)  # (node, hub)
    hubs: int = 0

    def add(self, owner: int, text: str, base: list[Span]) -> None:
        first, found = len(self.spans), mentions(text, base)
        words = [text[start:end] for start, end in found]
        numbers = [digits_of(word) for word in words]
        linked = [
            0 < b[0] - a[1] <= 3 and all(c in _TOGETHER for c in text[a[1] : b[0]]) for a, b in zip(found, found[1:])
        ]
        by_start = sorted((start, end, kind) for kind, start, end in base)
        place, open_ = 0, []
        for nth, ((start, end), word, number) in enumerate(zip(found, words, numbers)):
            while place < len(by_start) and by_start[place][0] < end:
                open_.append(by_start[place])
                place += 1
            open_ = [span for span in open_ if span[1] > start]
            before, after = nth > 0 and linked[nth - 1], nth < len(linked) and linked[nth]
            self.owner.append(owner)
            self.spans.append((start, end))
            self.labels.append(1 + min((kind for _, _, kind in open_), default=-1))
            self.shapes.append(
                (
                    _bucket(len(number), _DIGITS),
                    _bucket(sum(c.isalpha() for c in word[:8]), (1, 4)),
                    min(word.count("@"), 2),
                    min(word.count("."), 4),
                    int(word.startswith("+")),
                    min(word.count("-"), 2),
                    int(is_card(number)),
                    int(number != "" and set(word) <= set("0123456789.") and is_ip(word)),
                    int("@" in word and any(True for _ in _emails(word))),
                    1 + _bucket(len(numbers[nth - 1]), _NEIGHBOUR) if before else 0,
                    int(bool(before) and words[nth - 1].startswith("+")),
                    1 + _bucket(len(numbers[nth + 1]), _NEIGHBOUR) if after else 0,
                )
            )
            if before:
                self.chain.append((first + nth - 1, first + nth))
        self._keys(first, words, numbers, linked)

    def _keys(self, first: int, words: list[str], numbers: list[str], linked: list[bool]) -> None:
        """Links of mentions that are alike to the hub of what they share; keys of one mention alone give none."""
        sharing: dict[str, list[tuple[int, int]]] = {}  # by key: where it stands, and the node
        joined, phrase = "", []

        def close() -> None:
            # A number in several short parts stands in one place with all of them.
            if len(phrase) > 1 and 7 <= len(joined) <= 19 and max(len(numbers[node - first]) for node in phrase) < 10:
                for key in {"d" + joined, "d" + joined[-10:]}:
                    sharing.setdefault(key, []).extend((phrase[0], node) for node in phrase)

        for nth, (word, number) in enumerate(zip(words, numbers)):
            plain = not any(c.isalpha() or c == "@" for c in word)
            if nth and not linked[nth - 1] or not plain:
                close()
                joined, phrase = "", []
            if plain and len(joined) <= 19:  # a longer row of numbers is no single entity
                joined += number
                phrase.append(first + nth)
            keys = {"t" + word.lower()} if len(word) >= 4 else set()
            if "@" in word and len(word.split("@")[0]) >= 4:
                keys.add("t" + word.split("@")[0].lower())
            if len(number) >= 5:
                keys |= {"d" + number, "d" + number[-10:]}
            if len(number) >= 7:
                keys.add("e" + number[-7:])
            for key in keys:
                sharing.setdefault(key, []).append((first + nth, first + nth))
        close()
        # Keys that the same mentions share make one hub.
        shared = {tuple(nodes for _, nodes in found) for found in sharing.values() if len({place for place, _ in found}) > 1}
        for nodes in sorted(shared):
            self.keyed += [(node, self.hubs) for node in nodes]
            self.hubs += 1


# --- The field ---------------------------------------------------------------------------------------------------


def log_normal(logits: np.ndarray) -> np.ndarray:
    top = logits.max(axis=1, keepdims=True)
    return logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))


def _into(target: np.ndarray, messages: np.ndarray, size: int) -> np.ndarray:
    """Messages added up by the variable they go to."""
    return np.stack([np.bincount(target, weights=messages[:, label], minlength=size) for label in range(LABELS)], axis=1)


def _through(incoming: np.ndarray, link: np.ndarray) -> np.ndarray:
    """Messages over a link: log of the sum over the sender's labels."""
    both = incoming[:, :, None] + link[None]
    top = both.max(axis=1, keepdims=True)
    return log_normal((top + np.log(np.exp(both - top).sum(axis=1, keepdims=True)))[:, 0])


def marginals(own: np.ndarray, links: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rounds: int, damping: float) -> np.ndarray:
    """Log marginals by message passing over links (from, to, log potential of [label of from, label of to])."""
    size = len(own)
    sent = [(np.zeros((len(a), LABELS)), np.zeros((len(a), LABELS))) for a, _, _ in links]

    def beliefs() -> np.ndarray:
        total = own.copy()
        for (a, b, _), (forth, back) in zip(links, sent):
            total += _into(b, forth, size) + _into(a, back, size)
        return total

    for _ in range(rounds):
        total, new = beliefs(), []
        for (a, b, link), (forth, back) in zip(links, sent):
            to_b, to_a = _through(total[a] - back, link), _through(total[b] - forth, link.T)
            new.append((damping * forth + (1 - damping) * to_b, damping * back + (1 - damping) * to_a))
        sent = new
    return log_normal(beliefs())


@dataclass(frozen=True)
class Field:
    """Weights of the node factor, and log potentials of chain and shared links."""

    weights: np.ndarray
    chain: np.ndarray
    shared: np.ndarray

    def label(self, graph: Graph) -> np.ndarray:
        """Label of every node; nodes of base spans keep theirs."""
        n = len(graph.spans)
        labels = np.array(graph.labels, dtype=np.int64)
        if not n or not graph.keyed and not graph.chain:
            return labels
        own = np.zeros((n + graph.hubs, LABELS))
        own[:n] = log_normal(self.weights[np.array(graph.shapes) + OFFSETS].sum(axis=1))
        fixed = np.flatnonzero(labels)
        own[fixed] = -50.0
        own[fixed, labels[fixed]] = 0.0
        links = []
        for pairs, potential, shift in ((graph.chain, self.chain, 0), (graph.keyed, self.shared, n)):
            if pairs:
                a, b = np.array(pairs, dtype=np.int64).T
                links.append((a, b + shift, potential))
        found = np.exp(marginals(own, links, ROUNDS, DAMPING))[:n]
        best = found.argmax(axis=1)
        sure = (best > 0) & (found[np.arange(n), best] >= SURE)
        # What no label reaches through a link rests on its shape alone: that is the patterns' own affair.
        return np.where(labels > 0, labels, np.where(sure & self._reached(graph, labels), best, 0))

    @staticmethod
    def _reached(graph: Graph, labels: np.ndarray) -> np.ndarray:
        """Nodes that share a hub with a node of a base span, and those in a chain with such nodes."""
        reached = labels > 0
        if graph.keyed:
            node, hub = np.array(graph.keyed, dtype=np.int64).T
            told = np.bincount(hub, weights=reached[node], minlength=graph.hubs) > 0
            reached = reached.copy()
            reached[node[told[hub]]] = True
        reached = reached & (labels == 0)
        for pairs in (graph.chain, graph.chain[::-1]):
            for a, b in pairs:
                if pairs is graph.chain:
                    reached[b] |= reached[a] and labels[b] == 0
                else:
                    reached[a] |= reached[b] and labels[a] == 0
        return reached


def added_spans(graph: Graph, labels: np.ndarray) -> dict[int, list[Span]]:
    """New spans by owner: labelled mentions outside base spans, neighbours of one kind in one span."""
    linked = {b for _, b in graph.chain}
    runs: list[list[int]] = []
    for node in np.flatnonzero((labels > 0) & (np.array(graph.labels) == 0)).tolist():
        if runs and runs[-1][-1] == node - 1 and node in linked and labels[node] == labels[node - 1]:
            runs[-1].append(node)
        else:
            runs.append([node])
    out: dict[int, list[Span]] = {}
    for run in runs:
        kind, start, end = int(labels[run[0]]) - 1, graph.spans[run[0]][0], graph.spans[run[-1]][1]
        out.setdefault(graph.owner[run[0]], []).append((kind, start, end))
    return out


# --- Training ----------------------------------------------------------------------------------------------------


def graph_of(texts: list[str]) -> tuple[Graph, list[list[Span]]]:
    graph, bases = Graph(), []
    for owner, text in enumerate(texts):
        base = base_spans(text) if _TELLING.search(text) else []
        bases.append(base)
        if base:  # without a label nothing can spread
            graph.add(owner, text, base)
    return graph, bases


def labelled_counts(texts: list[str]) -> Counter:
    """Counts of (what, shape or label, label): shapes of all mentions, label pairs of chains and of repeats."""
    found: Counter = Counter()
    graph = Graph()
    for owner, text in enumerate(texts):
        if _TELLING.search(text):
            graph.add(owner, text, base_spans(text))
    told: dict[int, bool] = {}
    for node, hub in graph.keyed:
        told[hub] = told.get(hub, False) or graph.labels[node] > 0
    unlabelled = {node for node, hub in graph.keyed if told[hub] and graph.labels[node] == 0}
    for node, (shape, label) in enumerate(zip(graph.shapes, graph.labels)):
        if node not in unlabelled:
            found["shape", ",".join(map(str, shape)), label] += 1
    for a, b in graph.chain:
        if a not in unlabelled and b not in unlabelled:
            found["chain", str(graph.labels[a]), graph.labels[b]] += 1
    for _, links in groupby(graph.keyed, key=lambda link: link[1]):
        nodes = [node for node, _ in links if node not in unlabelled]
        for a, b in zip(nodes, nodes[1:]):
            found["shared", str(graph.labels[a]), graph.labels[b]] += 1
    return found


def fit_shapes(shapes: np.ndarray, labels: np.ndarray, counts: np.ndarray, ridge: float = 1e-6, steps: int = 400) -> np.ndarray:
    """Multinomial logistic regression on counted shapes, by steps under a fixed bound of the curvature."""
    rows = np.zeros((len(shapes), int(sum(SIZES))))
    np.put_along_axis(rows, shapes + OFFSETS, 1.0, axis=1)
    share = counts / counts.sum()
    target = np.eye(LABELS)[labels]
    curvature = 0.5 * (rows * share[:, None]).T @ rows + ridge * np.eye(rows.shape[1])
    inverse = np.linalg.inv(curvature)
    weights = np.zeros((rows.shape[1], LABELS))
    for _ in range(steps):
        error = target - np.exp(log_normal(rows @ weights))
        weights += inverse @ (rows.T @ (share[:, None] * error) - ridge * weights)
    return weights


def association(counts: np.ndarray, alike: float = 0.5, unlike: float = 0.5) -> np.ndarray:
    """Log potential of two labels meeting, half their log odds ratio: 0 for equal labels, less for others that rarely meet.

    How frequent a label is cancels out, as the node factors hold that. `alike` and `unlike` are counts assumed
    beforehand for a pair of equal and of different labels. A label that was never met twice, nor is assumed to be, gains
    nothing from meeting itself.
    """
    smooth = np.log(counts + counts.T + np.where(np.eye(LABELS) > 0, alike, unlike))
    same = smooth.diagonal() / 2
    potential = np.minimum(smooth - same[:, None] - same[None], 0)
    for label in range(LABELS):
        if counts[label, label] + alike < 1:
            potential[label, label] = np.delete(potential[label], label).max()
    return potential


def train(docs: DataFrame) -> Field:
    """The field of all documents of a table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            found += labelled_counts(batch.column(0).to_pylist())
        what, shape, label = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(what, pa.string()), pa.array(shape, pa.string()), pa.array(label, pa.int64()), pa.array(found.values(), pa.int64())],
            names=["what", "shape", "label", "n"],
        )

    texts = docs.select(whole_text(F.col("text")).alias("text"))
    counted = texts.mapInArrow(count, "what string, shape string, label long, n long")
    rows = counted.groupBy("what", "shape", "label").agg(F.sum("n").alias("n")).collect()
    pairs = {"chain": np.zeros((LABELS, LABELS)), "shared": np.zeros((LABELS, LABELS))}
    for row in rows:
        if row["what"] != "shape":
            pairs[row["what"]][int(row["shape"]), row["label"]] += row["n"]
    shapes = sorted((row["shape"], row["label"], row["n"]) for row in rows if row["what"] == "shape")
    weights = np.zeros((int(sum(SIZES)), LABELS))
    if shapes:
        values = np.array([[int(v) for v in shape.split(",")] for shape, _, _ in shapes])
        weights = fit_shapes(values, np.array([label for _, label, _ in shapes]), np.array([float(n) for _, _, n in shapes]))
    return Field(weights, association(pairs["chain"]), association(pairs["shared"], *AGREEMENT))


# --- Use ---------------------------------------------------------------------------------------------------------


def all_spans(texts: list[str], model: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    graph, bases = graph_of(texts)
    added = added_spans(graph, model.label(graph))
    return [(base, added.get(owner, [])) for owner, base in enumerate(bases)]


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def personal_data(docs: DataFrame, model: Field) -> DataFrame:
    """Every document's doc_id, base counts and digest, and all spans: base and added."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names[1:]]
            for base, added in all_spans(batch.column(1).to_pylist(), model):
                kinds = Counter(kind for kind, _, _ in base)
                digest = hashlib.sha256(spans_text(base).encode()).hexdigest()
                values = (*(kinds[k] for k in range(len(KINDS))), digest, spans_text(base + added), len(added))
                for column, value in zip(columns, values):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    texts = docs.select("doc_id", whole_text(F.col("text")).alias("text"))
    return texts.mapInArrow(find, f"doc_id {id_type}, {FOUND}")
