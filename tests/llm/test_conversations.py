"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from demandloom.llm import conversations as C
from demandloom.llm import queries

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        out += [] if fate == 0 else [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))


def plain_report(rows):
    """The figures of one conversation: the cheapest and then least audit, by extending whole audits row by row."""
    rows = in_order(rows)
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    best = {"": (0, "", [])}  # the last initial written -> cost, audit, rows

    def offer(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    def with_insertions(table):
        for _ in range(4):
            for key, (cost, audit, kept) in list(table.items()):
                to = "a" if key == "u" else "u"
                offer(table, to, (cost + 2, audit + "I", kept + [("assistant" if to == "a" else "user", "")]))
        return table

    for (_, _, role, text), fault in zip(rows, faults):
        now = {}
        for key, (cost, audit, kept) in with_insertions(best).items():
            offer(now, key, (cost + 3, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            extra, first = (fault == "truncated"), role[:1]
            if (key, first) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                offer(now, first, (cost + extra, audit + "K", kept + [(role, text)]))
            to = "a" if key == "u" else "u"
            offer(now, to, (cost + extra + 2, audit + "R", kept + [("assistant" if to == "a" else "user", text)]))
        best = now
    cost, audit, kept = min((best2 for key, best2 in with_insertions(best).items() if key in ("", "a")), key=lambda b: b[:2])
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def expected(rows, damaging=True):
    groups = defaultdict(list)
    for row in damage(rows) if damaging else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]:
        groups[row[0]].append(row)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    every = {r[0] for r in rows} if damaging else set(groups)
    return {conv: plain_report(groups[conv]) if conv in groups else empty for conv in every}


def as_found(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(seed, conversations=60):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", None, "What?\n", "Well. ", "a", "größe!", "x" * 70_000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "sys", "agent"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv if conv else None, None if rng.random() < 0.1 else turn * rng.choice([1, 1, 2]),
                         rng.choice(roles), rng.choice(texts)))
    return rows + rows[5:15]


def test_repair_equals_a_plain_search(spark):
    rows = random_rows(3)
    df = spark.createDataFrame([(*r, "clash") for r in rows], f"{SCHEMA}, audit string")
    assert as_found(C.repaired_after_damage(df)) == expected(rows)
    assert as_found(C.repair_report(df)) == expected(rows, damaging=False)


def test_query_on_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert as_found(queries.QUERIES["op11_conversations"](spark, SF)) == expected(rows)


def test_a_long_conversation_is_cut_into_pieces(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "user", "assistant"]), rng.choice(["Fine.", "open", f"Number {t}.", f"Number {t}."])) for t in range(700)]
    rows += [(7, 700 + t, "user", "the same") for t in range(400)] + [(8, t, "assistant", f"{t}!") for t in range(300)]
    plan = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seen = C.outline(spark.createDataFrame(rows, SCHEMA))
        ordered = seen.repartitionByRange("conv_id", "turn", "role", "mark").sortWithinPartitions("conv_id", "turn", "role", "mark")
        assert ordered.select("conv_id", "role", "copies", "blank", "cut", "first").mapInArrow(C._pieces, C.PIECE).count() > 3
        assert as_found(C.repair_report(spark.createDataFrame(rows, SCHEMA))) == expected(rows, damaging=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", plan)


def test_powers_are_repeated_steps():
    powers = C.Powers()
    for symbol in range(12):
        for length in (1, 2, 7, 64, 100):
            slow = C.FINAL
            for _ in range(length):
                slow = C.applied(C.step(symbol), slow)
            assert powers.before(symbol, length, C.FINAL) == slow == C.applied(powers.matrix(symbol, length), C.FINAL)


@pytest.mark.parametrize("length", [1, 63, 65, 200, 1000])
def test_unrolled_runs_have_the_cost_they_promise(length):
    powers = C.Powers()
    for symbol in range(12):
        audit, state = C.edits(powers, [(symbol, length)], C.FINAL, C.NOTHING, True)
        paid = {"K": 0, "R": 2, "D": 3, "I": 2}
        cut = symbol % 3 == C.CUT
        assert state in (C.NOTHING, C.ASSISTANT) and len(audit) - audit.count("I") == length
        assert sum(paid[c] + (cut and c in "KR") for c in audit) == powers.before(symbol, length, C.FINAL)[C.NOTHING]


def test_edits_are_listed_with_their_rows(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "user", "")], SCHEMA)
    plans = C.audits(C.outline(rows))
    found = [tuple(r) for r in C.repaired_turns(rows, plans).orderBy("place").collect()]
    assert found == [(1, 1, "K", 0, "user", "Hi."), (1, 2, "R", 1, "assistant", "There."), (1, 3, "D", 2, "user", "")]


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repaired_after_damage(none).count() == 0 and C.repair_report(none).count() == 0
