"""Conversation repair against an exhaustive search over edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from eventmart.llm import conversation_repair as cr

FORM = re.compile(r"(s?(ua)+)?")


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """All edit texts of `rows` [(initial, kind)] with up to three insertions, tried out."""
    best = None

    def go(at, cost, audit, made, inserted):
        nonlocal best
        if at == len(rows) and FORM.fullmatch(made):
            best = min(best or (cost, audit), (cost, audit))
        if inserted < 3:
            for role in "ua":
                go(at, cost + 5, audit + "I", made + role, inserted + 1)
        if at == len(rows):
            return
        initial, kind = rows[at]
        go(at + 1, cost + 2, audit + "D", made, inserted)
        if kind in ("blank", "duplicate"):
            return
        cut = 5 if kind == "truncated" else 0
        go(at + 1, cost + cut, audit + "K", made + (initial if initial in ("s", "u", "a") else "-"), inserted)
        for role in "ua":
            go(at + 1, cost + 1 + cut, audit + "R", made + role, inserted)

    go(0, 0, "", "", 0)
    return best


def symbol(initial: str, kind: str) -> str:
    known = initial if initial in ("s", "u", "a") else "o"
    return "x" if kind in ("blank", "duplicate") else known.upper() if kind == "truncated" else known


def by_matrices(grammar: cr.Grammar, seq: str, cut: int) -> tuple[int, str]:
    repair = cr.Repair(grammar)
    for at in range(0, len(seq), cut):
        repair.feed(grammar.compress(seq[at : at + cut]))
    return repair.finish()


UA, TWICE, GONE, CUT = (chr(cr.FIRST_RULE + i) for i in range(4))
RULES = [(UA, "u", "a"), (TWICE, UA, UA), (GONE, "x", "u"), (CUT, UA, "A")]


@pytest.mark.parametrize("seed", range(4))
def test_cheapest_edits(seed):
    rng = random.Random(seed)
    for _ in range(25):
        kinds = rng.choices(["", "blank", "duplicate", "truncated"], [6, 1, 1, 2], k=rng.randint(0, 5))
        rows = [(rng.choice("suaat"), kind) for kind in kinds]
        seq = "".join(symbol(*row) for row in rows)
        want = cheapest(rows)
        for rules in ([], RULES):
            for cut in (1, 2, 100):
                assert by_matrices(cr.Grammar(rules), seq, cut) == want, rows


def test_any_grammar_gives_the_same_edits():
    rng = random.Random(9)
    for _ in range(40):
        seq = "".join(rng.choice("uauauaxsSUAo") for _ in range(rng.randint(1, 300)))
        want = by_matrices(cr.Grammar([]), seq, 10**6)
        assert by_matrices(cr.Grammar(RULES), seq, 7) == want
        assert len(want[1].replace("I", "")) == len(seq)


def test_pairs_of_a_run_are_counted_as_replaced():
    for seq in ("aaaa", "aaaaa", "abaab", "aabb", "abababb", "aaabaaa"):
        found: Counter = Counter()
        cr.count_pairs(seq, 3, found)
        for pair, n in found.items():
            assert n == 3 * (len(seq) - len(seq.replace(pair, "#"))), (seq, pair)


def repaired(rows):
    """Brute force of the whole operator on rows (conv_id, turn, role, text)."""
    found = {}
    for conv, turn, role, text in rows:
        mine = found.setdefault(conv, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        mine += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = {}
    for conv, mine in found.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, kinds = set(), []
        for _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit = cheapest([(role[:1], kind) for (_, role, _), kind in zip(mine, kinds)])
        texts, at, state = [], 0, ""
        for edit in audit:
            row = None
            if edit != "I":
                row, at = mine[at], at + 1
            if edit == "D":
                continue
            role = row[1] if edit == "K" else "assistant" if state == "u" else "user"
            state = role[0]
            texts.append(f"{role}:{row[2] if row else ''}")
        turns = [t for t, _, _ in mine if t is not None]
        pairs = Counter(a[1][:1] + b[1][:1] in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(texts).encode()).hexdigest()
        counts = [kinds.count(kind) for kind in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, pairs[False], cost, audit, digest)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, kind string, seq string, rid string, copy string"


def frame(spark, rows):
    """With columns of the names the operator uses itself."""
    return spark.createDataFrame([(*row, "k", "s", "r", "c") for row in rows], SCHEMA)


def awkward():
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(40)]:
        for turn in rng.sample([None, *range(9)], rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            text = rng.choice(["Yes.", "No!", "It goes on", "", " \n", None, "Ünd?\t", "Yes.", "x" * 50_000 + "."])
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 2])
    return rows


def test_whole_operator(spark):
    rows = awkward()
    got = {r[0]: tuple(r[1:]) for r in cr.repair(frame(spark, rows).repartition(5)).collect()}
    assert got == repaired(rows)


def test_long_conversation_in_pieces(spark, monkeypatch):
    """A third of all rows in one conversation, and many repeats of one row: the same by pieces and rules."""
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"Say {i}." if i % 5 else "Again.") for i in range(600)]
    rows += [(100 + i // 4, i % 4, "assistant" if i % 2 else "user", f"Word {i}.") for i in range(1200)]
    whole = sorted(map(tuple, cr.repair(frame(spark, rows)).collect()))
    monkeypatch.setattr(cr, "PIECE", 16)
    assert sorted(map(tuple, cr.repair(frame(spark, rows).repartition(7)).collect())) == whole
    learned = cr.learn(cr.pieces_of(cr.faults(cr.damaged(frame(spark, rows)))))
    assert any(left + right == "ua" for _, left, right in learned.rules)
    long = next(row for row in whole if row[0] == 7)
    assert long[3] > 100 and len(long[7].replace("I", "")) > 550


def test_no_rows(spark):
    assert cr.repair(frame(spark, [])).collect() == []
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = cr.repair(frame(spark, [(dropped, 0, "user", "Hi.")])).collect()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
