"""Repair of conversation structure: dynamic programming over a grammar of role and fault sequences.

A conversation becomes a sequence of symbols, one per turn: who speaks and what is wrong. Re-Pair replaces
the most frequent neighbouring pairs of all sequences by new symbols. Each symbol has one min-plus matrix:
from every state of the wanted role order to every other, the cheapest edits and their audit, a rope
that shares its parts with the ropes of smaller symbols. The matrix of a rule is the product of its two parts',
so it is evaluated once and serves every conversation that holds it.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlode.llm.common import stored

#: White space between words.
BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits; a truncated turn that stays costs extra.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of the role order (s?(ua)+)?: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The speaker that an inserted or reroled turn gets in each state, and the state that follows.
NEXT = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
#: Turn symbols: speaker, upper case where truncated; D has to go.
TERMINALS = "DsuaoSUAO"
#: Symbols of a conversation that are handled as one sequence; longer conversations are several.
PIECE = 4096
#: Rules of the grammar, pairs replaced per round. A grammar cut short gives the same result with more products.
RULES, PAIRS = 4096, 256

# ---- ropes ------------------------------------------------------------------------------------

_MODULUS, _BASE = (1 << 127) - 1, 0x1F3D5B79A8642ECB97531
Rope = tuple  # (length, hash, base ** length, left part or character, right part)
EMPTY: Rope = (0, 0, 1, None, None)


def leaf(char: str) -> Rope:
    return (1, ord(char), _BASE, char, None)


def joined(a: Rope, b: Rope) -> Rope:
    if not a[0] or not b[0]:
        return a if a[0] else b
    return (a[0] + b[0], (a[1] * b[2] + b[1]) % _MODULUS, a[2] * b[2] % _MODULUS, a, b)


def rope_of(text: str) -> Rope:
    parts = [leaf(char) for char in text] or [EMPTY]
    while len(parts) > 1:
        parts = [joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def text_of(rope: Rope) -> str:
    out, todo = [], [rope]
    while todo:
        length, _, _, left, right = todo.pop()
        if length == 1:
            out.append(left)
        elif length:
            todo += [right, left]
    return "".join(out)


def before(a: Rope, b: Rope) -> bool:
    """Whether ``a`` sorts before ``b``; parts of equal hash are skipped whole."""
    xs, ys = [a], [b]
    while xs and ys:
        x, y = xs.pop(), ys.pop()
        if x[:2] == y[:2]:
            continue
        if x[0] <= 1 and y[0] <= 1:
            return (x[3] or "") < (y[3] or "")
        if x[0] >= y[0]:
            xs += [x[4], x[3]]
            ys.append(y)
        else:
            ys += [y[4], y[3]]
            xs.append(x)
    return bool(ys)


# ---- min-plus matrices: {(from, to): (cost, audit)} -----------------------------------------------

Matrix = dict


def product(a: Matrix, b: Matrix) -> Matrix:
    """Cheapest ways over both parts; ties go to the smaller audit.

    Equal costs between the same states never have one audit as the start of the other, since further
    inserts cost more; so the smaller of two audits stays the smaller whatever follows.
    """
    out: Matrix = {}
    for (i, k), (cost_a, audit_a) in a.items():
        for (other, j), (cost_b, audit_b) in b.items():
            if other != k:
                continue
            cost, old = cost_a + cost_b, out.get((i, j))
            if old is None or cost < old[0]:
                out[i, j] = (cost, joined(audit_a, audit_b))
            elif cost == old[0]:
                audit = joined(audit_a, audit_b)
                if before(audit, old[1]):
                    out[i, j] = (cost, audit)
    return out


IDENTITY: Matrix = {(state, state): (0, EMPTY) for state in NEXT}


def _inserts() -> Matrix:
    """Turns put in between: none, one or two; more lead nowhere new."""
    out = dict(IDENTITY)
    for state, (_, then) in NEXT.items():
        out[state, then] = (INSERT, leaf("I"))
        if (state, NEXT[then][1]) not in out:
            out[state, NEXT[then][1]] = (2 * INSERT, rope_of("II"))
    return out


INSERTS = _inserts()


def terminal(symbol: str) -> Matrix:
    """What may happen at one turn, turns inserted before it included."""
    step: Matrix = {(state, state): (DELETE, leaf("D")) for state in NEXT}
    if symbol != "D":
        extra = TRUNCATED if symbol.isupper() else 0
        for state, (role, then) in NEXT.items():
            kept = symbol.lower() == role[0]
            step[state, then] = (extra, leaf("K")) if kept else (extra + REROLE, leaf("R"))
        if symbol.lower() == "s":
            step[START, AFTER_S] = (extra, leaf("K"))
    return product(INSERTS, step)


def ended(row: Matrix) -> tuple[int, str]:
    """(cost, audit) of the cheapest way to a whole role order, from the row of the start state."""
    whole = product(row, INSERTS)
    ways = [whole[START, state] for state in (START, AFTER_A) if (START, state) in whole]
    best = ways[0]
    for way in ways[1:]:
        if way[0] < best[0] or way[0] == best[0] and before(way[1], best[1]):
            best = way
    return best[0], text_of(best[1])


class Grammar:
    """Rules in the rounds that found them, and the matrix of each symbol once it is needed."""

    def __init__(self):
        self.rounds: list[dict[tuple[int, int], int]] = []
        self.parts: dict[int, tuple[int, int]] = {}
        self.matrices: dict[int, Matrix] = {}

    def __getstate__(self):
        return {"rounds": self.rounds, "parts": self.parts, "matrices": {}}

    def add(self, pairs: list[tuple[int, int]]) -> None:
        first = len(TERMINALS) + len(self.parts)
        found = {pair: first + i for i, pair in enumerate(pairs)}
        self.rounds.append(found)
        self.parts.update({symbol: pair for pair, symbol in found.items()})

    def compressed(self, text: str) -> list[int]:
        symbols = [TERMINALS.index(char) for char in text]
        for found in self.rounds:
            out, i = [], 0
            while i < len(symbols):
                rule = found.get((symbols[i], symbols[i + 1])) if i + 1 < len(symbols) else None
                out.append(symbols[i] if rule is None else rule)
                i += 1 if rule is None else 2
            symbols = out
        return symbols

    def matrix(self, symbol: int) -> Matrix:
        if symbol not in self.matrices:
            if symbol < len(TERMINALS):
                self.matrices[symbol] = terminal(TERMINALS[symbol])
            else:
                left, right = self.parts[symbol]
                self.matrices[symbol] = product(self.matrix(left), self.matrix(right))
        return self.matrices[symbol]

    def whole(self, text: str, rows: Matrix) -> Matrix:
        """``rows`` carried over a sequence."""
        for symbol in self.compressed(text):
            rows = product(rows, self.matrix(symbol))
        return rows


# ---- damage, symbols, pieces -----------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by crc32(conv_id:turn) % 20.

    0 drops the row, 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 makes it the user's. Nulls
    are one space, in the text, the role and the hashed key.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    )
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        rows.where("fault <> 0")
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time"))
        .drop("time")
    )


def plain_turns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def with_symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, initial, fault, symbol), each conversation's turns together and in order.

    One shuffle, by conversation: the window that finds repeated turns and the final sort lie within it.
    """
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = (
        F.when(last == "", F.lit("blank"))
        .when(F.col("seen") > 1, F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated"))
    )
    speaker = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit("D"))
        .when(F.col("fault") == "truncated", F.upper(speaker))
        .otherwise(speaker)
    )
    return (
        rows.repartition("conv_id")
        .selectExpr("*", "row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) AS seen")
        .sortWithinPartitions("conv_id", "turn", "role", "text", "seen")
        .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
        .withColumn("symbol", symbol)
    )


COUNTS = ["blank", "duplicate", "truncated", "illegal"]


class _Piece:
    """The part of a conversation read so far."""

    def __init__(self, conv, place=0, turn=None, initial=None):
        self.conv, self.place, self.turn, self.initial = conv, place, turn, initial
        self.symbols: list[str] = []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.low = self.high = None
        self.distinct = 0

    def add(self, turn, initial, fault, symbol) -> None:
        self.symbols.append(symbol)
        if fault is not None:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        if turn is not None:
            self.distinct += turn != self.turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.turn, self.initial = turn, initial

    def row(self, last: bool) -> tuple:
        return (self.conv, self.place, last, "".join(self.symbols), *self.counts.values(), self.low, self.high, self.distinct)


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """Symbol sequences of at most ``size`` turns, with what was counted in each; streamed, never a whole conversation."""
    kind = dict(rows.dtypes)["conv_id"]
    schema = f"conv_id {kind}, piece int, last boolean, symbols string, {', '.join(f'{c} long' for c in COUNTS)}, low long, high long, distinct long"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        types = None
        for batch in batches:
            types = [batch.schema.field("conv_id").type, pa.int32(), pa.bool_(), pa.string(), *[pa.int64()] * (len(names) - 4)]
            for conv, *turn in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "symbol")), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row(True))
                    now = _Piece(conv)
                elif len(now.symbols) == size:
                    done.append(now.row(False))
                    now = _Piece(conv, now.place + 1, now.turn, now.initial)
                now.add(*turn)
            if done:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
                done = []
        if now is not None:
            done.append(now.row(True))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    return rows.mapInArrow(run, schema)


# ---- grammar of all sequences ---------------------------------------------------------------------


def pair_counts(shapes: DataFrame, grammar: Grammar) -> DataFrame:
    """(a, b, n): how often each pair of neighbouring symbols occurs in all sequences."""
    shared = shapes.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.value
        for batch in batches:
            counts: dict[tuple[int, int], int] = defaultdict(int)
            for text, n in zip(batch.column("symbols").to_pylist(), batch.column("n").to_pylist(), strict=True):
                symbols = grammar.compressed(text)
                for pair in zip(symbols, symbols[1:]):
                    counts[pair] += n
            rows = [(a, b, n) for (a, b), n in counts.items()]
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64()))], names=["a", "b", "n"])

    return shapes.mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def compatible(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs that no earlier one can overlap, so that all are replaced in one pass."""
    lefts, rights, out = set(), set(), []
    for a, b in pairs:
        if b not in lefts and a not in rights:
            out.append((a, b))
            lefts.add(a)
            rights.add(b)
    return out


def re_pair(sequences: DataFrame, rules: int = RULES) -> Grammar:
    """Rules for the pairs that occur most often, round by round; at most PAIRS counts per round reach the driver."""
    shapes = stored(sequences.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "shapes")
    grammar = Grammar()
    while len(grammar.parts) < rules:
        often = pair_counts(shapes, grammar).where("n > 1").orderBy(F.desc("n"), "a", "b").limit(PAIRS).collect()
        pairs = compatible([(row["a"], row["b"]) for row in often])[: rules - len(grammar.parts)]
        if not pairs:
            break
        grammar.add(pairs)
    return grammar


# ---- repair ---------------------------------------------------------------------------------------

STATES = [(i, j) for i in range(4) for j in range(4)]


def evaluated(parts: DataFrame, grammar: Grammar) -> DataFrame:
    """Pieces with their finished cost and audit, or, for parts of longer conversations, with their whole matrix."""
    shared = parts.sparkSession.sparkContext.broadcast(grammar)
    kept = [c for c in parts.columns if c != "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, known = shared.value, {}
        for batch in batches:
            costs, audits = [], []
            places, lasts = batch.column("piece").to_pylist(), batch.column("last").to_pylist()
            for text, place, last in zip(batch.column("symbols").to_pylist(), places, lasts, strict=True):
                alone = place == 0 and last
                if (text, alone) not in known:
                    if alone:
                        cost, audit = ended(grammar.whole(text, {(START, START): (0, EMPTY)}))
                        found = [cost], [audit]
                    else:
                        ways = grammar.whole(text, IDENTITY)
                        ways = [ways.get(way, (None, EMPTY)) for way in STATES]
                        found = [cost for cost, _ in ways], [text_of(audit) for _, audit in ways]
                    if len(known) > 65_536:
                        known.clear()
                    known[text, alone] = found
                found = known[text, alone]
                costs.append(found[0])
                audits.append(found[1])
            columns = [*(batch.column(c) for c in kept), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))]
            yield pa.record_batch(columns, names=[*kept, "costs", "audits"])

    kinds = dict(parts.dtypes)
    return parts.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", costs array<long>, audits array<string>")


def folded(parts: DataFrame) -> DataFrame:
    """One row per conversation: the counts of its pieces added up, their matrices multiplied in order."""
    kind = dict(parts.dtypes)["conv_id"]
    names = ["conv_id", "gaps", *COUNTS, "cost", "audit"]
    schema = f"conv_id {kind}, gaps long, {', '.join(f'{c} long' for c in COUNTS)}, cost long, audit string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts, low, high, distinct = None, [0] * len(COUNTS), None, None, 0
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                counts = [n + row[c] for n, c in zip(counts, COUNTS, strict=True)]
                distinct += row["distinct"]
                low = row["low"] if low is None else low
                high = high if row["high"] is None else row["high"]
                if len(row["costs"]) == 1:
                    cost, audit = row["costs"][0], row["audits"][0]
                else:
                    ways = {
                        way: (cost, rope_of(audit))
                        for way, cost, audit in zip(STATES, row["costs"], row["audits"], strict=True)
                        if cost is not None
                    }
                    rows = product({(START, START): (0, EMPTY)} if rows is None else rows, ways)
                    if row["last"]:
                        cost, audit = ended(rows)
                if row["last"]:
                    gaps = 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)
                    done.append((row["conv_id"], gaps, *counts, cost, audit))
                    rows, counts, low, high, distinct = None, [0] * len(COUNTS), None, None, 0
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * (len(names) - 2), pa.string()]
            columns = zip(*done) if done else [[]] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, schema)


def repair_plan(rows: DataFrame, size: int = PIECE, rules: int = RULES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: what is wrong with each conversation and the
    cheapest edits that give it the role order (s?(ua)+)?.

    ``rows`` hold conv_id, turn, role and text; other columns do not matter. A null role or text is one space, a null
    conv_id a conversation of its own, a null turn comes first. Turns of one number go by role, then
    text; repeated rows are repeated turns. An empty table gives an empty result. Texts and conversations may have any
    length: turns are streamed in order, a conversation longer than ``size`` in several pieces. A
    conversation's audit is one value, so its pieces meet in one task. Gaps beyond 64 bits are the
    largest number.
    """
    parts = stored(pieces(with_symbols(plain_turns(rows)), size), "pieces")
    return folded(evaluated(parts, re_pair(parts, rules)))


def repaired_turns(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns after the edits of ``plan``, from place 0, deleted ones left out.

    The rows of a conversation lie in one partition, in order. They are streamed beside its audit.
    """
    kind = dict(rows.dtypes)["conv_id"]
    audits = plan.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    turns = plain_turns(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text")
    together = audits.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")
    names = ["conv_id", "place", "edit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place, out = None, "", 0, START, 0, []

        def put(edit: str, role: str | None = None, text: str = "") -> None:
            nonlocal state, place
            wanted, then = NEXT[state]
            role = wanted if edit != "K" else role
            state = AFTER_S if state == START and role[:1] == "s" else then
            out.append((conv, place, edit, role, text))
            place += 1

        def inserts() -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                put("I")
                at += 1

        types = None
        for batch in batches:
            types = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text")), strict=True):
                if row[1] == 0:
                    inserts()
                    conv, audit, at, state, place = row[0], row[3], 0, START, 0
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit != "D":
                    put(edit, row[2], row[3])
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names=names)
            out.clear()
        inserts()
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return together.select("conv_id", "kind", "role", "text").mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def turn_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) over ``role:text`` lines, as the turns stream by in the order of :func:`repaired_turns`."""
    kind = dict(repaired.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind = None, None, None
        for batch in batches:
            done = []
            kind = batch.schema.field("conv_id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")), strict=True):
                if row[1] == 0:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = row[0], hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{row[2]}:{row[3]}".encode())
            yield pa.record_batch([pa.array([c for c, _ in done], kind), pa.array([h for _, h in done], pa.string())], names=["conv_id", "repaired_sha256"])
        if digest is not None:
            yield pa.record_batch([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The plan and the digest of the repaired turns for every conversation of ``conversations``, of which ``rows`` are left.

    A conversation without rows has zeros, no edits and the digest of nothing.
    """
    plan = stored(repair_plan(rows), "repair-plan")
    digests = turn_digests(repaired_turns(rows, plan))
    ids = conversations.select("conv_id").distinct().withColumnRenamed("conv_id", "id")
    told = ids.join(plan, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    told = told.join(digests, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    return told.select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS, "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
