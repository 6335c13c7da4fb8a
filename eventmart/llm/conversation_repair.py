"""Conversation repair: cheapest edits of role sequences, by min-plus matrices over a Re-Pair grammar.

Each row of a conversation becomes one symbol: its role's initial (s, u, a, or o for any other), upper case where the
text is cut off, or x where the row has to go (blank or repeated). The symbols of all conversations are compressed by
Re-Pair: the most frequent pair of neighbouring symbols becomes a rule, again and again. Every rule gets one matrix over
the states of the wanted form, whose entry (i, j) is the cheapest way from i to j through the rule's rows and the
text of its edits as a rope. A rule's matrix is the min-plus product of its two parts, so it is worked out once, bottom-up,
and a conversation only multiplies the few symbols that are left of it.

Form: `(s?(ua)+)?` of the initials. States: 0 nothing yet, 1 after s, 2 after u, 3 after a. A step first inserts, then
treats its row, so no text of edits ends in an insertion (but for the conversation's end). Two texts over the same rows
are then never one the beginning of the other, and the least whole is made of least parts.

Cases: a null role or text is one space (so its text is blank); a null turn stays null, comes first, and counts in no gap;
a null conv_id is a conversation of its own. Rows of one turn are ordered by role and digest of their text. Wholly equal rows
are repeats of each other. A conversation without rows gets zeros. Empty tables give no row. Further columns are ignored.
A gap count beyond a long is the largest long.

No conversation is held as a whole: rows come sorted by range and are cut into pieces. Only the digest of a repaired
conversation, a hash of one text, passes all its rows in order through one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import BLANKS
from eventmart.session import written

ACCEPTED = (0, 3)
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5, "cut": 5}
PIECE = 4096  # symbols of one row of pieces
MAX_RULES = 128
RARE = 512  # a pair rarer than one in so many symbols brings nothing
FIRST_RULE = 0xE000
LONG = 2**63 - 1
SALTS = 8


# --- Min-plus matrices -------------------------------------------------------------------------------------------

Rope = tuple  # ("text",) or (left, right)


def rope_text(rope: Rope) -> str:
    parts, open_ = [], [rope]
    while open_:
        node = open_.pop()
        if isinstance(node, str):
            parts.append(node)
        else:
            open_.extend(reversed(node))
    return "".join(parts)


def less(a, b) -> bool:
    """Entry a = (cost, rope) is cheaper than b, or as cheap and its text comes first."""
    if b is None or a[0] != b[0]:
        return b is None or a[0] < b[0]
    return rope_text(a[1]) < rope_text(b[1])


def product(left: list, right: list) -> list:
    """Min-plus product of matrices of (cost, rope) or None."""
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for k in range(4):
            if left[i][k] is None:
                continue
            for j in range(4):
                if right[k][j] is None:
                    continue
                entry = (left[i][k][0] + right[k][j][0], (left[i][k][1], right[k][j][1]))
                if less(entry, out[i][j]):
                    out[i][j] = entry
    return out


def insertions() -> list:
    """Insertions alone: none, or user and assistant in turn until the state is reached."""
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        state, text = i, ""
        while out[i][state] is None:
            out[i][state] = (COSTS["I"] * len(text), (text,))
            state, text = (3 if state == 2 else 2), text + "I"
    return out


def row_edits(symbol: str) -> list:
    """The edits of one row, without insertions."""
    out = [[None] * 4 for _ in range(4)]
    extra = COSTS["cut"] if symbol.isupper() else 0
    initial = symbol.lower()
    for i in range(4):
        choices = [(i, COSTS["D"], "D")]
        turned = 3 if i == 2 else 2
        if initial != "x":
            choices.append((turned, COSTS["R"] + extra, "R"))
            if (initial == "s" and i == 0) or initial == ("a" if i == 2 else "u"):
                choices.append((1 if initial == "s" else turned, COSTS["K"] + extra, "K"))
        for j, cost, text in choices:
            if less((cost, (text,)), out[i][j]):
                out[i][j] = (cost, (text,))
    return out


INSERTED = insertions()
SYMBOLS = "xsuaoSUAO"


class Grammar:
    """Matrices of all symbols under rules [(new symbol, left, right)], each rule's made once from those of its parts."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.rules = rules
        matrices = {s: product(INSERTED, row_edits(s)) for s in SYMBOLS}
        for name, left, right in rules:
            matrices[name] = product(matrices[left], matrices[right])
        # Per row of a matrix: the reachable states with cost, rope and place of the text among the row's texts.
        self.steps = {}
        for name, matrix in matrices.items():
            rows = []
            for row in matrix:
                order = sorted((j for j in range(4) if row[j]), key=lambda j: rope_text(row[j][1]))
                rows.append([(j, row[j][0], row[j][1], place) for place, j in enumerate(order)])
            self.steps[name] = rows

    def compress(self, seq: str) -> str:
        for name, left, right in self.rules:
            seq = seq.replace(left + right, name)
        return seq


class Repair:
    """The cheapest edits of one conversation, fed with compressed pieces in order."""

    def __init__(self, grammar: Grammar):
        self.steps = grammar.steps
        # Per state: cost, place of its text among those of all states, chain of ropes.
        self.states = {0: (0, 0, None)}

    def feed(self, seq: str) -> None:
        for symbol in seq:
            best = {}
            for i, (cost, place, chain) in self.states.items():
                for j, more, rope, among in self.steps[symbol][i]:
                    key = (cost + more, place, among)
                    if j not in best or key < best[j][0]:
                        best[j] = (key, chain, rope)
            order = sorted(best, key=lambda j: best[j][0][1:])
            self.states = {j: (best[j][0][0], place, (best[j][1], best[j][2])) for place, j in enumerate(order)}

    def finish(self) -> tuple[int, str]:
        ends = [
            (cost + INSERTED[i][j][0], place, rope_text(INSERTED[i][j][1]), chain)
            for i, (cost, place, chain) in self.states.items()
            for j in ACCEPTED
            if INSERTED[i][j] is not None
        ]
        cost, _, tail, chain = min(ends, key=lambda end: end[:3])
        parts = [tail]
        while chain is not None:
            chain, rope = chain
            parts.append(rope_text(rope))
        return cost, "".join(reversed(parts))


# --- Rows and their faults ---------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after damage, each with its row number `rid`, `copy` (0, or 1 for a repeat) and `dropped`."""
    conv, turn = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    plain = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
        F.monotonically_increasing_id().alias("rid"),
    )
    text = (
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return plain.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("fault") == 0).alias("dropped"),
        "rid",
        F.explode(copies).alias("copy"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """Damaged rows without their texts: order, initial of the role, and symbol ('' where dropped).

    A repeat is found in two rankings. The first ranks within salted parts of a group of equal rows, so that no task
    gets a large group; the second ranks only the first row of each part.
    """
    seen = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    light = rows.select(
        "conv_id", "turn", "role", "rid", "copy", "dropped", seen.alias("last"), _digest(F.col("text")).alias("digest")
    )
    judged = ~F.col("dropped") & (F.col("last") != "")
    by_order = "turn is null desc, turn, copy, rid"
    ranked = light.withColumn("judged", judged).withColumn(
        "salt", F.when(F.col("judged"), F.col("rid") % SALTS).otherwise(F.col("rid"))
    )
    group = "conv_id, role, case when {0} then digest end, case when {0} then {1} else rid end"
    ranked = ranked.withColumn(
        "nth", F.expr(f"row_number() over (partition by {group.format('judged', 'salt')} order by {by_order})")
    )
    ranked = ranked.withColumn("leads", F.col("judged") & (F.col("nth") == 1))
    ranked = ranked.withColumn(
        "nth", F.expr(f"row_number() over (partition by {group.format('leads', '0L')} order by {by_order})")
    )
    repeated = F.col("judged") & (~F.col("leads") | (F.col("nth") > 1))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    kind = (
        F.when(F.col("dropped"), "dropped")
        .when(F.col("last") == "", "blank")
        .when(repeated, "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    ranked = ranked.withColumn("kind", kind)
    symbol = (
        F.when(F.col("kind") == "dropped", "")
        .when(F.col("kind").isin("blank", "duplicate"), "x")
        .when(F.col("kind") == "truncated", F.upper(known))
        .otherwise(known)
    )
    order = ["conv_id", "turn", "role", "digest", "copy", "rid"]
    return ranked.select(*order, "kind", initial.alias("initial"), symbol.alias("symbol"))


PIECES = (
    "conv_id {0}, part int, piece int, seq string, first_initial string, last_initial string, first_turn long, last_turn long, "
    "turns long, blank long, duplicate long, truncated long, illegal long"
)
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class Piece:
    """What a run of rows of one conversation adds up to."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.symbols: list[str] = []
        self.first_initial = self.last_initial = self.first_turn = self.last_turn = None
        self.turns = self.illegal = 0
        self.kinds: Counter = Counter()

    def add(self, turn, kind: str, initial: str, symbol: str) -> None:
        if kind == "dropped":
            return
        self.kinds[kind] += 1
        self.symbols.append(symbol)
        if self.last_initial is None:
            self.first_initial = initial
        elif (self.last_initial, initial) not in _LEGAL:
            self.illegal += 1
        self.last_initial = initial
        if turn is not None:
            if turn != self.last_turn:
                self.turns += 1
            if self.first_turn is None:
                self.first_turn = turn
            self.last_turn = turn

    def row(self, part: int, number: int) -> tuple:
        return (
            self.conv_id, part, number, "".join(self.symbols), self.first_initial, self.last_initial, self.first_turn,
            self.last_turn, self.turns, self.kinds["blank"], self.kinds["duplicate"], self.kinds["truncated"], self.illegal,
        )


def arrow_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _arrow_schema(frame_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(frame_schema)


def pieces_of(light: DataFrame) -> DataFrame:
    """Runs of at most PIECE rows of a conversation, in order of (part, piece). Every conversation has one at least."""
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "copy", "rid"]
    ordered = light.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.select("conv_id", "turn", "kind", "initial", "symbol")
    kind = light.schema["conv_id"].dataType.simpleString()
    spark = light.sparkSession
    empty = spark.createDataFrame([], PIECES.format(kind))
    schema = _arrow_schema(empty.schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            part, number, piece = TaskContext.get().partitionId(), 0, None
            for batch in batches:
                for conv_id, turn, fault, initial, symbol in zip(*(c.to_pylist() for c in batch.columns)):
                    if piece is not None and (piece.conv_id != conv_id or len(piece.symbols) == PIECE):
                        yield piece.row(part, number)
                        number += 1
                        piece = None
                    if piece is None:
                        piece = Piece(conv_id)
                    piece.add(turn, fault, initial, symbol)
            if piece is not None:
                yield piece.row(part, number)

        return arrow_batches(rows(), schema)

    return ordered.mapInArrow(cut, empty.schema)


# --- The grammar -------------------------------------------------------------------------------------------------


def count_pairs(seq: str, times: int, found: Counter) -> None:
    """Neighbouring symbols that a replacement from left to right would take, weighted."""
    previous, run = "", 0
    for left, right in zip(seq, seq[1:]):
        if left == right:
            run = run + 1 if previous == left else 1
            previous = left
            if run % 2 == 0:  # the middle of a run belongs to one pair only
                continue
        else:
            previous, run = "", 0
        found[left + right] += times


def learn(pieces: DataFrame, max_rules: int = MAX_RULES, rare: int = RARE) -> Grammar:
    """Re-Pair over the symbols of all pieces. Equal pieces are counted once, with their number.

    A round counts all pairs on the executors and makes rules of the most frequent ones that share no symbol, so that they
    do not disturb each other's counts. The driver gets the counts of at most (rules + 9) squared pairs.
    """
    seqs = written(pieces.where("length(seq) > 1").groupBy("seq").agg(F.count(F.lit(1)).alias("times")), "sequences")
    rules: list[tuple[str, str, str]] = []
    while len(rules) < max_rules:
        grammar = Grammar(rules)

        def count(batches: Iterator[pa.RecordBatch], grammar=grammar) -> Iterator[pa.RecordBatch]:
            found, total = Counter(), 0
            for batch in batches:
                for seq, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    seq = grammar.compress(seq)
                    total += len(seq) * times
                    count_pairs(seq, times, found)
            pairs = [*found, ""]
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array([*found.values(), total])], names=["pair", "n"])

        counts = seqs.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        found = {row["pair"]: row["n"] for row in counts.collect()}
        total = found.pop("", 0)
        taken: set[str] = set()
        before = len(rules)
        for pair, n in sorted(found.items(), key=lambda item: (-item[1], item[0])):
            if n < 2 or n * rare < total or len(rules) == max_rules:
                break
            if not taken & set(pair):
                taken |= set(pair)
                rules.append((chr(FIRST_RULE + len(rules)), *pair))
        if len(rules) == before:
            break
    return Grammar(rules)


# --- Repair ------------------------------------------------------------------------------------------------------

REPAIRED = (
    "conv_id {0}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


class Conversation:
    """One conversation as its pieces and then its rows go by: sums, edits, digest of the repaired text."""

    def __init__(self, conv_id, grammar: Grammar):
        self.conv_id, self.grammar = conv_id, grammar
        self.repair = Repair(grammar)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.last_initial = None
        self.cost = self.audit = None
        self.at, self.state, self.begun, self.digest = 0, 0, False, hashlib.sha256()

    def piece(self, seq, first_initial, last_initial, first_turn, last_turn, turns, blank, duplicate, truncated, illegal) -> None:
        self.repair.feed(self.grammar.compress(seq))
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.illegal += illegal
        if first_initial is not None:
            self.illegal += self.last_initial is not None and (self.last_initial, first_initial) not in _LEGAL
            self.last_initial = last_initial
        if first_turn is not None:
            self.turns += turns - (first_turn == self.last_turn)
            if self.first_turn is None:
                self.first_turn = first_turn
            self.last_turn = last_turn

    def decide(self) -> None:
        if self.audit is None:
            self.cost, self.audit = self.repair.finish()
            self.repair = None

    def _put(self, role: str, text: str) -> None:
        if self.begun:
            self.digest.update(b"\n")
        self.begun = True
        self.digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

    def _turned(self) -> str:
        self.state = 3 if self.state == 2 else 2
        return "user" if self.state == 2 else "assistant"

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self._put(self._turned(), "")

    def text(self, role: str, text: str) -> None:
        self.decide()
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = {"s": 1, "u": 2, "a": 3}[role[0]]
            self._put(role, text)
        elif edit == "R":
            self._put(self._turned(), text)

    def row(self) -> tuple:
        self.decide()
        self._insert()
        gaps = 0 if self.first_turn is None else min(self.last_turn - self.first_turn + 1 - self.turns, LONG)
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit,
            self.digest.hexdigest(),
        )


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults after the damage, the cheapest edits, and the digest of what they make."""
    hurt = damaged(rows)
    pieces = written(pieces_of(faults(hurt)), "pieces")
    grammar = learn(pieces)
    texts = hurt.where("not dropped").withColumn("digest", _digest(F.col("text")))
    texts = texts.select("conv_id", F.lit(1).alias("what"), "turn", "role", "digest", "copy", "rid", "text")
    both = pieces.withColumn("what", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    keys = ["conv_id", "what", "part", "piece", F.col("turn").asc_nulls_first(), "role", "digest", "copy", "rid"]
    sums = [name for name in pieces.columns if name not in ("conv_id", "part", "piece")]
    # The pieces of a conversation come before its rows.
    stream = both.repartition("conv_id").sortWithinPartitions(*keys).select("conv_id", "what", "role", "text", *sums)
    result = REPAIRED.format(rows.schema["conv_id"].dataType.simpleString())
    empty = rows.sparkSession.createDataFrame([], result)
    schema = _arrow_schema(empty.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            conversation = None
            for batch in batches:
                for conv_id, what, role, text, *summed in zip(*(c.to_pylist() for c in batch.columns)):
                    if conversation is None or conversation.conv_id != conv_id:
                        if conversation is not None:
                            yield conversation.row()
                        conversation = Conversation(conv_id, grammar)
                    if what == 0:
                        conversation.piece(*summed)
                    else:
                        conversation.text(role, text)
            if conversation is not None:
                yield conversation.row()

        return arrow_batches(found(), schema)

    return stream.mapInArrow(run, empty.schema)
