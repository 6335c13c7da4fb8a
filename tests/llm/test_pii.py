"""Personal data: patterns against plain regular expressions, messages against enumeration, labels on planted documents."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from eventmart.llm import pii


def plain_spans(text: str):
    """The patterns as they are stated, with the standard search."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and pii.luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    return [(k, *m.span()) for k, (rule, right) in enumerate(rules) for m in re.finditer(rule, text) if right(m.group())]


def test_patterns():
    rng = random.Random(4)
    pieces = ["a", "b.c", "@", ".", "1", "255", "300", "4111111111111111", "4111 1111-1111 1111", "+", "+1 (", ")", " ", "-", "é", "00", "12345678"]
    for _ in range(20_000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_luhn():
    for number, right in (("4111111111111111", True), ("4111111111111112", False), ("79927398713", True), ("0", True)):
        assert pii.luhn(number) is right


@pytest.mark.parametrize("unit", ["1", "1.", "a", "a@", "@", "+1 ", "1 ", "1-", "a.", "+1(", "1@a "])
def test_linear_scans(unit):
    """Long texts of one unit take about as long per character as short ones."""
    spans = pii.base_spans("1" * 6000)  # digits beyond what a number may have
    assert spans == []
    started = time.time()
    text = unit * (300_000 // len(unit))
    graph, _ = pii.graph_of([text + " x@y.zz"])
    assert graph.owner
    assert time.time() - started < 20


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(3)
    own = rng.normal(size=(5, pii.LABELS))
    one, two = rng.normal(size=(2, pii.LABELS, pii.LABELS))
    links = [(np.array([0, 1]), np.array([1, 2]), one), (np.array([1, 3]), np.array([4, 4]), two)]
    want = np.zeros((5, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=5):
        score = sum(own[i, label] for i, label in enumerate(labels))
        score += sum(link[labels[a], labels[b]] for froms, tos, link in links for a, b in zip(froms, tos))
        for i, label in enumerate(labels):
            want[i, label] += np.exp(score)
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(np.exp(pii.marginals(own, links, 40, 0.3)), want, atol=1e-6)


WORDS = "the of inning tha one reth est ende ount mail".split()


def card(rng) -> str:
    head = "4" + "".join(rng.choices("0123456789", k=14))
    return next(head + c for c in "0123456789" if pii.luhn(head + c))


def planted(seed: int, n: int):
    """Texts with entities, some of them a second time in a form that no pattern takes, numbers that are nothing, and what is where."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        said, wanted, decoys = [], [], []
        for kind in rng.sample(["email", "ip", "card", "phone"], rng.randint(0, 3)):
            number = "".join(rng.choices("0123456789", k=10))
            mail = f"{rng.choice(WORDS)}.{rng.choice(WORDS)}{number[:3]}"
            digits = card(rng)
            ip = ".".join(str(rng.randint(10, 255)) for _ in range(4))
            form, again = {
                "email": (f"{mail}@mail{number[4]}.example.com", f"{mail} at mail"),
                "ip": (ip, f"{ip}:8080"),
                "card": (digits, f"{digits[:4]}.{digits[4:8]}.{digits[8:12]}.{digits[12:]}"),
                "phone": (f"+1 ({number[:3]}) 555-{number[6:]}", f"({number[:3]}) 555-{number[6:]}"),
            }[kind]
            said.append(form)
            if rng.random() < 0.5 and kind != "ip":
                said.append(again)
                wanted.append((kind, again))
        if rng.random() < 0.5:
            decoys.append("".join(rng.choices("0123456789", k=rng.choice([3, 4, 6, 16, 22]))))
            decoys = [d for d in decoys if not pii.base_spans(d)]
            said += decoys
        rng.shuffle(said)
        text = " ".join(w for s in said for w in [*rng.choices(WORDS, k=6), s]) + " end."
        docs.append((i, text, wanted, decoys))
    return docs


@pytest.fixture(scope="module")
def model(spark):
    docs = planted(1, 1500)
    return pii.train(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(4))


def test_held_out(model):
    """Repeats in other forms are found, plain numbers are left alone."""
    hit = asked = false = 0
    for _, text, wanted, decoys in planted(2, 800):
        ((base, added),) = pii.all_spans([text], model)
        assert base == plain_spans(text)
        for kind, again in wanted:
            asked += 1
            covered = {i for _, s, e in base for i in range(s, e)}
            start = next(m.start() for m in re.finditer(re.escape(again), text) if m.start() + 1 not in covered)
            hit += any(pii.KINDS[k] == kind and s < start + len(again) and e > start for k, s, e in added)
        for decoy in decoys:
            start = text.index(decoy)
            false += any(s < start + len(decoy) and e > start for _, s, e in added)
        assert not any(s < f and b < e for _, s, e in added for _, b, f in base)
    assert asked > 200 and hit / asked >= 0.9 and false <= 4


def test_many_repeats(model):
    """A document of nothing but one mention, thousands of times, takes links in proportion."""
    text = "+1 (123) 555-4567 " + "call 555-4567 " * 5000
    graph, _ = pii.graph_of([text])
    assert len(graph.keyed) < 6 * len(graph.spans)
    pii.all_spans([text], model)


ROWS = [(1, "mail a.b@c.example.org now"), (1, "mail a.b@c.example.org now"), (2, None), (3, ""), (None, "10.0.0.1 é 10.0.0.1"), (4, "x" * 200_000 + " +1 234 567 8901")]


def test_frame(spark, model):
    rows = spark.createDataFrame([(*r, 7, "s") for r in ROWS], "doc_id long, text string, n_email int, spans string").repartition(3)
    got = sorted(map(tuple, pii.personal_data(rows, model).collect()), key=str)
    want = []
    for doc_id, text in ROWS:
        base, added = pii.all_spans([text or ""], model)[0]
        assert base == plain_spans(text or "")
        digest = hashlib.sha256(pii.spans_text(base).encode()).hexdigest()
        counts = [sum(k == kind for k, _, _ in base) for kind in range(4)]
        want.append((doc_id, *counts, digest, pii.spans_text(base + added), len(added)))
    assert got == sorted(want, key=str)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(empty, pii.train(empty)).collect() == []
