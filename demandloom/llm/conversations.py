"""Conversation structure repair: a dynamic program over runs of equal rows, in min-plus algebra.

A repaired conversation reads ``(s?(ua)+)?`` by the initials of its roles. Four states say what has been written so far:
nothing, a system row, a user row, an assistant row. A row is one of twelve symbols (role by fault); what it can cost to
go from state to state over a row, with the insertions before it, is a 4 x 4 matrix in which sums are minima and products
are sums. A run of equal symbols is a power of that matrix, made of binary powers that are kept per symbol.

1. *Outline.* Rows without their texts (a digest, a few flags), equal rows once with their number. Earlier copies of a text
   are found by a grouped minimum and a join, not by looking at a conversation as one group.
2. *Pieces.* The outline is sorted by range, so a long conversation is spread over tasks; each task reduces its piece to
   runs and to one matrix. What remains to be paid after each piece goes backwards over the pieces' matrices.
3. *Choices.* Each piece unrolls its runs into edits for the states it may begin in (a run is halved until it is short,
   the costs in its middle come from the powers); the states are then followed forwards.
4. *Texts* meet their edits in one sorted pass that holds the audit of one conversation and one batch of rows.

The edits of a conversation and its hash are single values, so they end in one task; everything else is spread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm import words as W
from demandloom.llm.storage import written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
RANK, DROPPED, TRUNCATED = 2, 3, 1  # fixed costs: a new role or row, a row dropped, an unfinished row left
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
SOUND, CUT, GONE = range(3)  # faults: none, unfinished, must go
FAR = 1 << 60
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEXT = (USER, USER, ASSISTANT, USER)  # what may be inserted, or a row be turned into, after each state
KEPT = {(NOTHING, SYSTEM), (NOTHING, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
STRETCH = 64  # rows unrolled at once
BLANK = "[^\\x20\\x09-\\x0D]"
ENDED = "[.!?][\\x20\\x09-\\x0D]*\\z"

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def initial(role: str) -> int:
    """The state a kept row of this role leads to; 0 for a role that no repaired conversation has."""
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], NOTHING)


@lru_cache(1 << 14)
def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in range(4)), FAR) for j in range(4)) for i in range(4))


@lru_cache(1 << 14)
def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(min(a[i][k] + v[k] for k in range(4)), FAR) for i in range(4))


def _inserted() -> Matrix:
    """Any number of insertions."""
    rows = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        at, cost = state, 0
        while rows[state][at] > cost:
            rows[state][at] = cost
            at, cost = NEXT[at], cost + RANK
    return tuple(map(tuple, rows))


IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
INSERTED = _inserted()
FINAL: Vector = applied(INSERTED, (0, FAR, FAR, 0))


def symbol_of(role: int, fault: int) -> int:
    return role * 3 + fault


def step(symbol: int) -> Matrix:
    """Insertions, then one row kept, given a role or dropped."""
    role, fault = divmod(symbol, 3)
    rows = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        rows[state][state] = DROPPED
        if fault != GONE:
            extra = TRUNCATED if fault == CUT else 0
            rows[state][NEXT[state]] = min(rows[state][NEXT[state]], RANK + extra)
            if (state, role) in KEPT:
                rows[state][role] = min(rows[state][role], extra)
    return product(INSERTED, tuple(map(tuple, rows)))


class Powers:
    """The binary powers of each symbol's matrix, made when first needed."""

    def __init__(self) -> None:
        self._known: dict[int, list[Matrix]] = {}

    def binary(self, symbol: int, length: int) -> Iterator[Matrix]:
        known = self._known.setdefault(symbol, [step(symbol)])
        while len(known) < length.bit_length():
            known.append(product(known[-1], known[-1]))
        return (known[bit] for bit in range(length.bit_length()) if length >> bit & 1)

    def matrix(self, symbol: int, length: int) -> Matrix:
        whole = IDENTITY
        for power in self.binary(symbol, length):  # powers of one matrix commute
            whole = product(whole, power)
        return whole

    def before(self, symbol: int, length: int, after: Vector) -> Vector:
        """What remains to be paid before a run, given what remains after it."""
        for power in self.binary(symbol, length):
            after = applied(power, after)
        return after


def choose(symbol: int, before: Vector, after: Vector, state: int, out: list[str]) -> int:
    """Write the edits up to and including one row, ASCII-least among the cheapest; the state that follows."""
    role, fault = divmod(symbol, 3)
    extra = TRUNCATED if fault == CUT else 0
    while True:
        owed = before[state]
        if DROPPED + after[state] == owed:
            out.append(DELETE)
            return state
        if RANK + before[NEXT[state]] == owed:
            out.append(INSERT)
            state = NEXT[state]
        elif (state, role) in KEPT and extra + after[role] == owed:
            out.append(KEEP)
            return role
        else:
            out.append(REROLE)
            return NEXT[state]


def unroll(powers: Powers, symbol: int, length: int, after: Vector, state: int, out: list[str]) -> int:
    """The edits of a run; memory follows the logarithm of its length."""
    if length > STRETCH:
        half = length // 2
        middle = powers.before(symbol, length - half, after)
        state = unroll(powers, symbol, half, middle, state, out)
        return unroll(powers, symbol, length - half, after, state, out)
    owed = [after]
    for _ in range(length):
        owed.append(powers.before(symbol, 1, owed[-1]))
    for k in range(length, 0, -1):
        state = choose(symbol, owed[k], owed[k - 1], state, out)
    return state


def edits(powers: Powers, runs: list[tuple[int, int]], after: Vector, state: int, last: bool) -> tuple[str, int]:
    """The edits of a piece that begins in ``state``, and the state it ends in."""
    owed = [after]
    for symbol, length in reversed(runs):
        owed.append(powers.before(symbol, length, owed[-1]))
    out: list[str] = []
    for k, (symbol, length) in enumerate(runs):
        state = unroll(powers, symbol, length, owed[len(runs) - k - 1], state, out)
    while last and state in (SYSTEM, USER):
        out.append(INSERT)
        state = NEXT[state]
    return "".join(out), state


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with known faults put in by the checksum of ``conv_id:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes it the user's. Nulls of role, text
    and in the checksum's text read as one space; a null ``conv_id`` or ``turn`` stays null.
    """
    space = F.lit(" ")
    part = [F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    fate = F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
        fate.alias("fate"),
    ).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def _plain(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))


def _mark() -> Column:
    return F.unhex(F.sha2(F.col("text"), 256))


def outline(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, mark, copies, blank, cut, first``: equal rows once, without their texts.

    ``first``: no earlier turn of the conversation has this role and text.
    """
    seen = rows.select(
        "conv_id", "turn", "role", _mark().alias("mark"), (~F.col("text").rlike(BLANK)).alias("blank"),
        (~F.col("text").rlike(ENDED)).alias("cut"),
    ).groupBy("conv_id", "turn", "role", "mark", "blank", "cut").agg(F.count("*").alias("copies"))
    seen = written(seen, "talk-outline")
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    earliest = seen.groupBy("conv_id", "role", "mark").agg(F.min(at).alias("least")).alias("e")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ("conv_id", "role", "mark")]
    joined = seen.alias("s").join(earliest, same[0] & same[1] & same[2])
    return written(joined.select("s.*", F.col("s.turn").eqNullSafe(F.col("e.least.turn")).alias("first")), "talk-outline")


PIECE = "conv_id bigint, piece int, symbols array<int>, lengths array<bigint>, matrix array<bigint>, opens int, closes int, illegal bigint"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted outline rows of a task: one row per conversation that has some here."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int32()), ("symbols", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int64())),
        ("matrix", pa.list_(pa.int64())), ("opens", pa.int32()), ("closes", pa.int32()), ("illegal", pa.int64()),
    ])
    powers, piece, done = Powers(), TaskContext.get().partitionId(), []
    at, open_, role, illegal, runs = None, False, NOTHING, 0, []
    opens = NOTHING

    def closed() -> dict:
        matrix = IDENTITY
        for symbol, length in runs:
            matrix = product(matrix, powers.matrix(symbol, length))
        return {"conv_id": at, "piece": piece, "symbols": [s for s, _ in runs], "lengths": [n for _, n in runs],
                "matrix": [x for row in matrix for x in row], "opens": opens, "closes": role, "illegal": illegal}

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv_id, name, copies, blank, cut, first in zip(*columns):
            now = initial(name)
            if not open_ or conv_id != at:
                if open_:
                    done.append(closed())
                at, open_, opens, illegal, runs = conv_id, True, now, 0, []
            elif (role, now) not in LEGAL:
                illegal += 1
            illegal, role = illegal + copies - 1, now
            lead = 1 if first and not blank else 0
            for fault, length in ((CUT if cut else SOUND, lead), (GONE, copies - lead)):
                symbol = symbol_of(now, fault)
                if length and runs and runs[-1][0] == symbol:
                    runs[-1] = (symbol, runs[-1][1] + length)
                elif length:
                    runs.append((symbol, length))
            if len(done) >= 1024:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
    if open_:
        done.append(closed())
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def _owed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation from the last to the first: what is owed after each, before it, and its neighbours."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int32()), ("after", pa.list_(pa.int64())), ("owed", pa.int64()),
        ("first", pa.bool_()), ("last", pa.bool_()), ("broken", pa.int64()),
    ])
    held, done = None, []
    owed, later_opens = FINAL, NOTHING
    for batch in batches:
        for conv_id, piece, flat, opens, closes in zip(*(batch.column(i).to_pylist() for i in range(5))):
            more = held is not None and held["conv_id"] == conv_id
            if held is not None:
                done.append(held | {"first": not more})
            after = owed if more else FINAL
            owed = applied(tuple(tuple(flat[4 * i : 4 * i + 4]) for i in range(4)), after)
            held = {"conv_id": conv_id, "piece": piece, "after": list(after), "owed": owed[NOTHING], "last": not more,
                    "broken": int(more and (closes, later_opens) not in LEGAL)}
            later_opens = opens
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if held is not None:
        yield pa.RecordBatch.from_pylist([held | {"first": True}], schema)


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece, for each state it may begin in, its edits and the state it ends in."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int32()), ("audits", pa.list_(pa.string())), ("ends", pa.list_(pa.int32())),
    ])
    powers = Powers()
    for batch in W.slices(batches):
        done = []
        for row in batch.to_pylist():
            runs = list(zip(row["symbols"], row["lengths"]))
            begins = (NOTHING,) if row["first"] else range(4)
            found = [edits(powers, runs, tuple(row["after"]), state, row["last"]) for state in begins]
            done.append({"conv_id": row["conv_id"], "piece": row["piece"], "audits": [a for a, _ in found], "ends": [e for _, e in found]})
        yield pa.RecordBatch.from_pylist(done, schema)


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces from the first to the last: the edits chosen by the state each begins in."""
    schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int32()), ("part", pa.string())])
    at, state = object(), NOTHING
    for batch in W.slices(batches):
        done = []
        for conv_id, piece, audits, ends in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if conv_id != at:
                at, state = conv_id, NOTHING
            chosen = state if len(audits) > 1 else 0
            done.append({"conv_id": conv_id, "piece": piece, "part": audits[chosen]})
            state = ends[chosen]
        yield pa.RecordBatch.from_pylist(done, schema)


def audits(seen: DataFrame) -> DataFrame:
    """``conv_id, audit, cost, illegal`` from the rows of ``outline``, one row per conversation that has rows."""
    ordered = seen.repartitionByRange("conv_id", "turn", "role", "mark").sortWithinPartitions("conv_id", "turn", "role", "mark")
    pieces = written(ordered.select("conv_id", "role", "copies", "blank", "cut", "first").mapInArrow(_pieces, PIECE), "talk-pieces")
    backward = pieces.select("conv_id", "piece", "matrix", "opens", "closes").repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("piece"))
    owed = written(backward.mapInArrow(
        _owed, "conv_id bigint, piece int, after array<bigint>, owed bigint, first boolean, last boolean, broken bigint"), "talk-owed")
    same = F.col("p.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("p.piece") == F.col("o.piece"))
    met = pieces.alias("p").join(owed.alias("o"), same)
    choices = met.select("p.conv_id", "p.piece", "symbols", "lengths", "after", "first", "last").mapInArrow(
        _choices, "conv_id bigint, piece int, audits array<string>, ends array<int>")
    forward = choices.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    parts = forward.mapInArrow(_followed, "conv_id bigint, piece int, part string")
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("piece", "part"))).alias("parts"))
    sums = met.groupBy("p.conv_id").agg(
        F.sum(F.when(F.col("first"), F.col("owed"))).alias("cost"), F.sum(F.col("illegal") + F.col("broken")).alias("illegal"))
    return written(whole.alias("w").join(sums.alias("s"), F.col("w.conv_id").eqNullSafe(F.col("s.conv_id"))).select(
        "w.conv_id", F.array_join("parts.part", "").alias("audit"), "cost", "illegal"), "talk-audits")


TURN = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's audit comes first, then its rows in order; rows come out as they are edited."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ])
    conv_id, audit, at, state, done = None, "", 0, NOTHING, []

    def written_row(edit: str, turn: int | None, role: str, text: str) -> None:
        nonlocal at, state
        if edit in (INSERT, REROLE):
            state = NEXT[state]
            role = NAMES[state]
        elif edit == KEEP:
            state = initial(role)
        at += 1
        done.append({"conv_id": conv_id, "place": at, "edit": edit, "turn": turn, "role": role, "text": text})

    for batch in W.slices(batches, 128):
        for own, turn, role, text, plan in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if plan is not None:
                while at < len(audit):
                    written_row(INSERT, None, "", "")
                conv_id, audit, at, state = own, plan, 0, NOTHING
                continue
            while audit[at] == INSERT:
                written_row(INSERT, None, "", "")
            written_row(audit[at], turn, role, text)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    while at < len(audit):
        written_row(INSERT, None, "", "")
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``conv_id, place, edit, turn, role, text``: every edit of ``plans`` (``conv_id, audit``) with the row it meets.

    Deleted rows are listed with edit ``D``; inserted ones have no turn and an empty text.
    """
    nothing = F.lit(None)
    texts = _plain(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", _mark().alias("mark"), "text", nothing.cast("string").alias("audit"))
    heads = plans.select("conv_id", F.lit(0).alias("kind"), nothing.cast("bigint").alias("turn"), nothing.cast("string").alias("role"),
                         nothing.cast("binary").alias("mark"), nothing.cast("string").alias("text"), "audit")
    ordered = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "mark")
    return ordered.select("conv_id", "turn", "role", "text", "audit").mapInArrow(_turns, TURN)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    at, open_, running, begun, done = None, False, hashlib.sha256(), False, []
    for batch in batches:
        for conv_id, edit, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "edit", "role", "text"))):
            if not open_ or conv_id != at:
                if open_:
                    done.append({"conv_id": at, "repaired_sha256": running.hexdigest()})
                at, open_, running, begun = conv_id, True, hashlib.sha256(), False
            if edit != DELETE:
                running.update(f"{'\n' if begun else ''}{role}:{text}".encode())
                begun = True
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if open_:
        yield pa.RecordBatch.from_pylist([{"conv_id": at, "repaired_sha256": running.hexdigest()}], schema)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` in ``rows`` (``conv_id, turn, role, text``; other columns are ignored).

    ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Rows are taken by turn, nulls first; rows
    of one turn by role, then by the SHA-256 of their text, so repeated rows stand together and all but the first are
    duplicates. A null ``conv_id`` is a conversation of its own, null roles and texts are one space, roles count by their
    first letter as it stands. Texts of any length pass through one at a time. No rows give no report.
    """
    rows = _plain(rows)
    seen = outline(rows)
    lead = F.when(F.col("first") & ~F.col("blank"), 1).otherwise(0)
    counts = seen.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("copies") - lead).otherwise(0)).alias("duplicate"),
        F.sum(F.when(F.col("cut"), lead).otherwise(0)).cast("bigint").alias("truncated"))
    plans = audits(seen)
    hashes = repaired_turns(rows, plans).mapInArrow(_hashes, "conv_id bigint, repaired_sha256 string")
    met = counts.alias("c").join(plans.alias("a"), F.col("c.conv_id").eqNullSafe(F.col("a.conv_id")))
    return met.join(hashes.alias("h"), F.col("c.conv_id").eqNullSafe(F.col("h.conv_id"))).select(
        "c.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired_after_damage(conversations: DataFrame) -> DataFrame:
    """``repair_report`` of the damaged rows, for every original ``conv_id``: zeros and empty texts where no row is left."""
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    found = repair_report(damaged(conversations)).alias("f")
    joined = every.alias("e").join(found, F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        "e.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
