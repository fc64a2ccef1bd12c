"""Conversation repair against an alignment with every target by itself."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from affinity.llm import turn_repair
from affinity.llm.catalog import LLM_QUERIES
from affinity.llm.common import read_table
from affinity.llm.turn_repair import Known, align, audit_of, damage, repair_conversations, repaired_turns

SF = "/root/testdata/sf0.001"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def targets(n):
    yield ""
    for k in range(1, n + 3):
        yield "ua" * k
        yield "s" + "ua" * k


def least_repair(turns):
    """(cost, audit) of (initial, fault) turns, from every alignment with every target."""
    best = (10**9, "")
    for goal in targets(len(turns)):

        @lru_cache(None)
        def go(i, j):
            ways = []
            if i < len(turns):
                first, fault = turns[i]
                c, a = go(i + 1, j)
                ways.append((c + 2, "D" + a))
                if j < len(goal) and fault not in ("blank", "duplicate"):
                    c, a = go(i + 1, j + 1)
                    extra = 5 * (fault == "truncated")
                    if first == goal[j]:
                        ways.append((c + extra, "K" + a))
                    if goal[j] != "s":
                        ways.append((c + extra + 1, "R" + a))
            if j < len(goal) and goal[j] != "s":
                c, a = go(i, j + 1)
                ways.append((c + 5, "I" + a))
            if i == len(turns) and j == len(goal):
                ways.append((0, ""))
            return min(ways, default=(10**9, ""))

        best = min(best, go(0, 0))
    return best


def expected(rows):
    """rows: (conv_id, turn, role, text) after damage, each as often as it is there."""
    by = defaultdict(list)
    for c, *row in rows:
        by[c].append(row)
    out = {}
    for c, turns in by.items():
        turns = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns if t != "gone"]
        digest = lambda r, x: hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest()
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], digest(t[1], t[2])))
        faults, seen = [], set()
        for _, r, x in turns:
            left = x.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not left else "duplicate" if (r, x) in seen else "truncated" if left[-1] not in ".!?" else ""
            seen.add((r, x))
            faults.append(fault)
        cost, audit = least_repair([(r[:1], f) for (_, r, _), f in zip(turns, faults)])
        length = sum(e in "KRI" for e in audit)
        goal = ("s" if length % 2 else "") + "ua" * (length // 2)
        i, lines = 0, []
        for e in audit:
            role = {"u": "user", "a": "assistant"}.get(goal[len(lines)]) if e in "RI" else None
            if e in "KR":
                lines.append(f"{role or turns[i][1]}:{turns[i][2]}")
            elif e == "I":
                lines.append(f"{role}:")
            i += e != "I"
        assert GRAMMAR.fullmatch("".join(x[0] for x in lines))
        known = [t for t, _, _ in turns if t is not None]
        first = [r[:1] for _, r, _ in turns]
        out[c] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            faults.count("blank"),
            faults.count("duplicate"),
            faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def damaged(rows):
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        if kind == 0:
            yield c, "gone", None, None
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            yield c, t, role, text


TURNS = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "", "", "blank", "duplicate", "truncated"])), max_size=9)
FAULTS = ["", "blank", "duplicate", "truncated"]


def marks_of(turns):
    return bytes("sua".find(f) % 4 * 4 + FAULTS.index(fault) for f, fault in turns)


@given(TURNS)
@settings(max_examples=400, deadline=None)
def test_audits_are_cheapest_and_least(turns):
    assert audit_of(marks_of(turns)) == least_repair(turns)


@given(TURNS)
@settings(max_examples=100, deadline=None)
def test_rows_computed_again_give_the_same(turns):
    """The same with rows of the table kept at every second turn only."""
    keep = turn_repair.Table.__init__

    def small(self, turns, incumbent):
        sqrt, turn_repair.isqrt = turn_repair.isqrt, lambda n: 2
        try:
            keep(self, turns, incumbent)
            if self.n > 2:
                full, self.step = self.kept, 2
                row = full[self.n]
                self.kept = {self.n: row}
                for i in range(self.n - 1, -1, -1):
                    row = self._above(i, row)
                    if i % 2 == 0:
                        self.kept[i] = row
        finally:
            turn_repair.isqrt = sqrt

    turn_repair.Table.__init__ = small
    try:
        assert audit_of(marks_of(turns)) == least_repair(turns)
    finally:
        turn_repair.Table.__init__ = keep


def test_hand_cases():
    ok = lambda s: [(c, 0) for c in s]
    assert align([]) == (0, "")
    assert align(ok("s")) == (2, "D")
    assert align(ok("sua")) == (0, "KKK")
    assert align(ok("uu")) == (1, "KR")
    assert align(ok("u")) == (2, "D")
    assert align(ok("uua")) == (2, "DKK")
    assert align([("u", 5), ("a", 0)]) == (4, "DD")
    assert align(ok("au")) == (2, "RR")


def test_long_conversations():
    """A thousand turns with faults: the cost equals that of an automaton that forgets the length."""
    rng = np.random.default_rng(2)
    turns = [("ua"[k % 2], 0) for k in range(1200)]
    turns = [(str(rng.choice(list("sua"))) if rng.random() < 0.1 else f, 5 * (rng.random() < 0.05)) for f, _ in turns]
    turns = [t for t in turns if rng.random() > 0.05]
    best = {"": 0}
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(costs):
        for _ in range(2):
            for (a, c), b in step.items():
                if c != "s" and a in costs:
                    costs[b] = min(costs.get(b, 10**9), costs[a] + 5)
        return costs

    best = inserted(best)
    for first, extra in turns:
        new = {q: c + 2 for q, c in best.items()}
        for (a, c), b in step.items():
            if a in best and (c == first or c != "s"):
                new[b] = min(new.get(b, 10**9), best[a] + extra + (c != first))
        best = inserted(new)
    cost, audit = align(turns)
    assert cost == min(best.get("", 10**9), best.get("a", 10**9))
    spent = i = 0
    for e in audit:
        spent += {"D": 2, "I": 5, "K": 0, "R": 1}[e] + (turns[i][1] if e in "KR" else 0)
        i += e != "I"
    assert i == len(turns) and spent == cost


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in LLM_QUERIES["op11_turn_repair"](spark, SF).collect()}
    assert got == expected(damaged(rows)) and len(got) == len({r[0] for r in rows})


SCHEMA = "conv_id long, turn long, role string, text string, mark int, place int, copies int, digest int, audit int"


def cases():
    rows = [(1, t, "ua"[t % 2] == "u" and "user" or "assistant", f"Text {t}.") for t in range(9)]
    rows += [(2, None, "user", "A."), (2, None, None, None), (2, 5, "assistant", "B"), (2, 5, "assistant", "B")]
    rows += [(3, t, "user", "Same.") for t in range(6)] + [(4, 0, "", "x."), (4, 1, "system", " "), (4, 2, "userland", "Y!")]
    rows += [(None, 0, "user", "No id."), (None, 1, "assistant", "None?"), (5, None, "tool", " \t\n\x0b\x0c\r")]
    rows += [(6, 1, "user", "b."), (6, 1, "user", "a."), (6, 1, "assistant", "c."), (6, 1, "assistant", "c.")]
    rows += [(7, 0, "system", "S."), (7, 1, "user", "long " * 50000 + "."), (7, 9, "assistant", "é" * 30000)]
    return rows


def test_cases(spark):
    rows = cases()
    table = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_conversations(damage(table)).collect()}
    assert got == expected(damaged(rows))
    undamaged = repair_conversations(table.drop("copies"))
    assert {r["conv_id"]: tuple(r)[1:] for r in undamaged.collect()} == expected(rows)
    empty = repair_conversations(table.limit(0).drop("copies"))
    assert empty.count() == 0 and repaired_turns(table.limit(0)).count() == 0


def test_a_conversation_of_which_nothing_is_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    row = repair_conversations(damage(table)).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_are_the_hashed_ones(spark):
    rows = cases()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = defaultdict(list)
    for r in repaired_turns(table).orderBy("conv_id", "place").collect():
        assert r["place"] == len(lines[r["conv_id"]])
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in repair_conversations(table).collect():
        assert hashlib.sha256("\n".join(lines[r["conv_id"]]).encode()).hexdigest() == r["repaired_sha256"]


def test_one_conversation_with_a_third_of_all_rows(spark):
    n = 6000
    table = spark.range(3 * n).select(
        F.when(F.col("id") < n, -1).otherwise(F.col("id") % 500).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("Turn "), F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    row = repair_conversations(damage(table)).where("conv_id = -1").first()
    kinds = [zlib.crc32(f"-1:{t}".encode()) % 20 for t in range(n)]
    assert len(row["audit"]) - row["audit"].count("I") == n - kinds.count(0) + kinds.count(3)
    assert row["blank"] == kinds.count(1) and row["duplicate"] == kinds.count(3) and row["truncated"] == kinds.count(2)


def test_remembered_audits_are_bounded(monkeypatch):
    monkeypatch.setattr(turn_repair, "KNOWN_BYTES", 5000)
    known = Known()
    for k in range(200):
        known.audit(bytes([4, 8] * (k % 40 + 1)) + bytes([k % 4 + 4]))
        assert known.held <= 5000 + 250 + 2 * turn_repair.KNOWN_TURNS
