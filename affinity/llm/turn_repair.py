"""Conversation structure repair: Wagner-Fischer alignment with the alternating grammar.

A conversation's role initials must read ``(s?(ua)+)?``. There is one such string of each length but
one, so every feasible length is one target string. Turns are aligned with the targets by Keep (0),
Rerole to user or assistant (1), Delete (2, required for blank and duplicate turns) and Insert of an
empty user or assistant turn (5); a truncated turn that stays adds 5. The cheapest audit is
returned: the edits' initials in order, of equally cheap ones the least in ASCII order.

* Turns that must go are left out of the alignment. Their ``D`` comes as soon as the turn before them is
  done, which is the least order (``D`` < ``I``) and costs the same.
* What is left of a target is known by its length, so ``G[i][m]``, the least cost of turns ``i..`` against ``m``
  characters, serves every length at once; a leading ``s`` is a second table over the same rows.
* Ukkonen's band: ``m`` characters for ``r`` turns need ``m - r`` insertions or ``r - m`` deletions. Cells for which
  these alone cost more than the incumbent, a greedy repair by deletions, are left out.
* The backtraces of all cheapest lengths are walked together. While they agree they share the turn and the cost,
  so the audits are compared letter by letter: the least edit that any of them can take is the audit's next.
* Rows of the table are kept at every ``sqrt(n)``-th turn and computed again in between.

Conversations are sorted by Spark and stream through tasks: first each one's marks (a byte, a digest and a turn
number a row, no text), from which the audit follows, then its rows again with text, one by one. So a task
holds some 150 bytes a turn of one conversation, and never its texts. A conversation's hash and audit run over its
turns in order, hence it is one task's work; its band is what its faults cost.

Order: by turn, nulls first; rows of one turn by role, then by the MD5 of role and text (equal rows
adjoin). Faults count once a row: blank (nothing but ASCII white space), duplicate (role and text seen
before), truncated (the last other character is none of ``.!?``).

Cases: a null role or text is one space; a null conversation id is a conversation of its own; null turns
count for no gap; an empty role has no initial and fits nothing; repeated rows are duplicates; a
conversation of which no row is left has zeros, an empty audit and the hash of the empty string; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructType

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"
#: A turn's mark is its initial's number here (3: any other) times 4, plus its fault.
INITIALS = "sua"
NO_FAULT, BLANK, DUPLICATE, CUT = range(4)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
ROLES = {"u": "user", "a": "assistant"}
FAR = 1 << 40
#: Conversations up to this many turns are remembered by their marks, up to so many bytes a task.
KNOWN_TURNS, KNOWN_BYTES = 256, 16 << 20


def initial(mark: int) -> str:
    return INITIALS[mark >> 2] if mark >> 2 < 3 else "-"


def target(left: int) -> str:
    """The character of a target before its last ``left - 1`` ones (a leading ``s`` apart)."""
    return "ua"[left % 2]


def greedy_cost(turns: list[tuple[str, int]]) -> int:
    """The cost of deleting every turn that is truncated or out of turn."""
    kept = 0
    last = ""
    for first, extra in turns:
        if not extra and ((last, first) in LEGAL or (not last and first in "su")):
            kept, last = kept + 1, first
    # A repair ends in an assistant's turn; a system's turn alone is none.
    kept -= last in ("s", "u")
    return DELETE * (len(turns) - (0 if kept == 1 else kept))


class Table:
    """Least costs of the turns from ``i`` on against ``m`` characters, inside the band.

    ``row(i)`` gives two arrays by ``m``: with no ``s`` ahead, and with one.
    """

    def __init__(self, turns: list[tuple[str, int]], incumbent: int):
        self.n = len(turns)
        self.first = [f for f, _ in turns]
        self.extra = [e for _, e in turns]
        self.fewer, self.more = incumbent // DELETE, incumbent // INSERT
        self.step = max(1, isqrt(self.n)) if self.n > 64 else self.n + 1
        self.system = "s" in self.first
        m = np.arange(self.more + 1, dtype=np.int64)
        row = INSERT * m, np.full(len(m), FAR)
        self.kept = {self.n: row}
        for i in range(self.n - 1, -1, -1):
            row = self._above(i, row)
            if i % self.step == 0:
                self.kept[i] = row
        self.block, self.rows = None, {}

    def least(self, i: int) -> int:
        """The band's first ``m`` of a row."""
        return max(0, self.n - i - self.fewer)

    def _above(self, i: int, below: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        lo, lo_below = self.least(i), self.least(i + 1)
        m = np.arange(lo, self.n - i + self.more + 1, dtype=np.int64)
        g, s = below
        # G[i + 1][m] and G[i + 1][m - 1] for the m of this row.
        same = np.append(g, FAR)[lo - lo_below :]
        before = np.concatenate(([FAR], g))[lo - lo_below :]
        fits = np.array([self.first[i] != "u", self.first[i] != "a"], dtype=np.int64)[m % 2] * REROLE
        base = np.minimum(DELETE + same, np.where(m > 0, before + fits + self.extra[i], FAR))
        cost = np.minimum.accumulate(base - INSERT * m) + INSERT * m
        with_system = DELETE + np.append(s, FAR)[lo - lo_below :] if self.system else s
        if self.first[i] == "s":
            with_system = np.minimum(with_system, np.where((m > 2) & (m % 2 == 1), before + self.extra[i], FAR))
        return cost, with_system

    def row(self, i: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Row ``i`` while rows of the given block, up to its end inclusive, are walked."""
        if block != self.block:
            top = min(self.n, (block + 1) * self.step)
            self.block, self.rows = block, {top: self.kept[top]}
            for k in range(top - 1, block * self.step - 1, -1):
                self.rows[k] = self._above(k, self.rows[k + 1])
        return self.rows[i]


def _at(row: np.ndarray, m: np.ndarray, least: int) -> np.ndarray:
    """Values of a row at ``m``; far outside the band."""
    at = m - least
    inside = (at >= 0) & (at < len(row))
    return np.where(inside, row[np.where(inside, at, 0)] if len(row) else FAR, FAR)


def align(turns: list[tuple[str, int]]) -> tuple[int, str]:
    """The least cost of (initial, extra cost of staying) turns, and the least audit of that cost."""
    n = len(turns)
    table = Table(turns, greedy_cost(turns))
    plain, system = table.row(0, 0)
    lo = table.least(0)
    lengths = np.arange(lo, lo + len(plain))
    plain_costs = np.where(lengths % 2 == 0, plain, FAR)
    left = cost = int(min(plain_costs.min(), system.min(initial=FAR) if table.system else FAR))
    # The lengths still in the race, without and with an s to come.
    m, w = lengths[plain_costs == cost], lengths[system == cost] if table.system else lengths[:0]
    audit, i = [], 0
    while not (i == n and (m == 0).any()):
        block = i // table.step
        here, lo = table.row(i, block)[0], table.least(i)
        if i < n:
            first, extra = turns[i]
            (below, s_below), lo_below = table.row(i + 1, block), table.least(i + 1)
            m_to, w_to = m[_at(below, m, lo_below) == left - DELETE], w[_at(s_below, w, lo_below) == left - DELETE]
            if len(m_to) or len(w_to):
                audit.append("D")
                m, w, i, left = m_to, w_to, i + 1, left - DELETE
                continue
        inserted = m[(m > 0) & (_at(here, m - 1, lo) == left - INSERT)]
        if len(inserted):
            audit.append("I")
            m, w, left = inserted - 1, w[:0], left - INSERT
            continue
        stays = _at(below, m - 1, lo_below)
        kept = m[(m > 0) & (m % 2 == "ua".find(first)) & (stays == left - extra)]
        if first == "s":
            kept = np.concatenate((kept, w[_at(below, w - 1, lo_below) == left - extra]))
        if len(kept):
            audit.append("K")
            m, w, i, left = kept - 1, w[:0], i + 1, left - extra
            continue
        audit.append("R")
        m = m[(m > 0) & (m % 2 != "ua".find(first)) & (stays == left - extra - REROLE)] - 1
        w, i, left = w[:0], i + 1, left - extra - REROLE
    return cost, "".join(audit)


def audit_of(marks: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    must_go = [mark & 3 in (BLANK, DUPLICATE) for mark in marks]
    cost, aligned = align([(initial(x), TRUNCATED * (x & 3 == CUT)) for x, gone in zip(marks, must_go) if not gone])
    out, at = [], 0
    for gone in must_go:
        if not gone:
            while aligned[at] == "I":
                out.append("I")
                at += 1
        out.append("D" if gone else aligned[at])
        at += not gone
    return cost + DELETE * sum(must_go), "".join(out) + aligned[at:]


class Conversation:
    """One conversation while its rows stream by: first marks, then rows with text."""

    def __init__(self, key):
        self.key = key
        self.marks = bytearray()
        self.seen: set[bytes] = set()
        self.turns = self.distinct = 0
        self.low = self.high = None
        self.audit = None

    def mark(self, mark: int, turn, digest: bytes, copies: int) -> None:
        for _ in range(copies):
            fault = mark & 3
            if fault != BLANK and digest in self.seen:
                fault = DUPLICATE
            self.seen.add(digest)
            self.marks.append(mark & ~3 | fault)
        if copies and turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def settle(self, known: "Known") -> None:
        if self.audit is None:
            self.seen = set()
            marks = bytes(self.marks)
            self.cost, self.audit = known.audit(marks)
            self.length = len(self.audit) - self.audit.count("D")
            self.at = self.place = 0

    def _emit(self, edit: str, role: str, text: str):
        self.place += 1
        return self.place - 1, edit, role, text

    def _due(self) -> str:
        return ROLES[target(self.length - self.place)]

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._emit("I", self._due(), "")

    def row(self, role: str, text: str, copies: int):
        """The repaired turns (place, edit, role, text) up to this row."""
        for _ in range(copies):
            yield from self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                yield self._emit(edit, self._due() if edit == "R" else role, text)

    def summary(self) -> tuple:
        faults = [x & 3 for x in self.marks]
        first = [initial(x) for x in self.marks]
        illegal = sum(pair not in LEGAL for pair in zip(first, first[1:]))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        counts = (faults.count(k) for k in (BLANK, DUPLICATE, CUT))
        return self.key, gaps, *counts, illegal, self.cost, self.audit


class Known:
    """Audits of short conversations by their marks, up to a number of bytes."""

    def __init__(self):
        self.audits: dict[bytes, tuple[int, str]] = {}
        self.held = 0

    def audit(self, marks: bytes) -> tuple[int, str]:
        found = self.audits.get(marks)
        if found is None:
            found = audit_of(marks)
            if len(marks) <= KNOWN_TURNS:
                if self.held > KNOWN_BYTES:
                    self.audits, self.held = {}, 0
                self.audits[marks] = found
                self.held += 250 + 2 * len(marks)
        return found


def _stream(batches: Iterator[pa.RecordBatch], schema: pa.Schema, turns: bool):
    known, now, out = Known(), None, []
    digest = None

    def flush(least: int = 1):
        nonlocal out
        if len(out) >= least:
            columns = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            out = []

    def take(emitted):
        for place, edit, role, text in emitted:
            if turns:
                out.append((now.key, place, edit, role, text))
            else:
                digest.update(f"{chr(10) * (place > 0)}{role}:{text}".encode())

    def finish():
        now.settle(known)
        take(now.inserts())
        if not turns:
            out.append((*now.summary(), digest.hexdigest()))

    names = ("conv_id", "with_text", "turn", "role", "digest", "mark", "text", "copies")
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            columns = [batch.column(c).slice(lo, 512).to_pylist() for c in names]
            for key, with_text, turn, role, mark_of, mark, text, copies in zip(*columns):
                if now is None or now.key != key:
                    if now is not None:
                        finish()
                    now, digest = Conversation(key), hashlib.sha256()
                if with_text:
                    now.settle(known)
                    take(now.row(role, text, copies))
                else:
                    now.mark(mark, turn, mark_of, copies)
            yield from flush(1024 if not turns else 256)
    if now is not None:
        finish()
    yield from flush()


def damage(conversations: DataFrame) -> DataFrame:
    """Drops, empties, cuts, repeats and re-roles rows by the CRC-32 of ``conv_id:turn`` modulo 20.

    Gives conv_id, turn, role, text and copies, the number of times that the row is there.
    """
    space = F.lit(" ")
    name = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = name("text")
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(name("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _sorted(rows: DataFrame) -> DataFrame:
    """Each conversation's marks in order, then its rows in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.cast("int").alias("copies"))
    seen = F.rtrim("text", F.lit(WHITE))
    fault = F.when(seen == "", BLANK).when(F.right(seen, F.lit(1)).isin(".", "!", "?"), NO_FAULT).otherwise(CUT)
    place = F.when(F.length("role") > 0, F.instr(F.lit(INITIALS), F.left("role", F.lit(1)))).otherwise(0)
    marked = plain.withColumn("mark", F.when(place > 0, place - 1).otherwise(3) * 4 + fault).withColumn(
        "digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    )
    shape = lambda df, with_text, **own: df.select(
        "conv_id", F.lit(with_text).alias("with_text"), "turn", "role", "digest",
        own.get("mark", F.lit(None).cast("int")).alias("mark"), own.get("text", F.lit(None).cast("string")).alias("text"), "copies",
    )
    marks = shape(marked, False, mark=F.col("mark"))
    # A row that is not there still names its conversation, without text.
    texts = shape(marked.where("copies > 0"), True, text=F.col("text"))
    order = ["conv_id", "with_text", "turn", "role", "digest"]
    return marks.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows``: conv_id, turn, role, text, and copies where a row is there several times or not at all. The hash is that
    of the repaired ``role:text`` lines, joined by line feeds.
    """
    out = StructType([rows.schema["conv_id"]])
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        out = out.add(name, LongType())
    out = out.add("audit", StringType()).add("repaired_sha256", StringType())
    schema = to_arrow_schema(out)
    return _sorted(rows).mapInArrow(lambda it: _stream(it, schema, False), out)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    out = StructType([rows.schema["conv_id"]]).add("place", LongType())
    for name in ("edit", "role", "text"):
        out = out.add(name, StringType())
    schema = to_arrow_schema(out)
    return _sorted(rows).mapInArrow(lambda it: _stream(it, schema, True), out)
