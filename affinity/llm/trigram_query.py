"""Boolean trigram queries of regular expressions.

For each part of an expression the analysis keeps what a match of it must look like: all its
strings when they are few (``exact``), else sets that hold a prefix and a suffix of every
match, and a query over trigrams that every match's text satisfies. Parts are joined by the
rules of concatenation and alternation; sets that grow are folded into the query first, which
loses selectivity only. Letters are folded to lower case, so a text is folded before it is
looked up.

A query is ``True`` (no mandatory trigram), a trigram, or ``("and" | "or", parts)``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

_parser = re._parser
_MAX_SET = 24


def all_of(parts) -> object:
    flat = set()
    for p in parts:
        if p is not True:
            flat |= set(p[1]) if isinstance(p, tuple) and p[0] == "and" else {p}
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("and", frozenset(flat))


def any_of(parts) -> object:
    flat = set()
    for p in parts:
        if p is True:
            return True
        flat |= set(p[1]) if isinstance(p, tuple) and p[0] == "or" else {p}
    # A part that asks for more than another adds nothing.
    needs = {p: p[1] if isinstance(p, tuple) and p[0] == "and" else frozenset({p}) for p in flat}
    flat = {p for p in flat if not any(needs[q] < needs[p] for q in flat)}
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("or", frozenset(flat))


def grams_of(text: str) -> object:
    return all_of(text[i : i + 3] for i in range(len(text) - 2))


def _of_set(strings) -> object:
    return any_of(grams_of(s) for s in strings) if strings else True


@dataclass(frozen=True)
class Part:
    exact: frozenset | None
    prefix: frozenset
    suffix: frozenset
    query: object

    def folded(self) -> "Part":
        """The same without exact strings."""
        if self.exact is None:
            return self
        return Part(
            None,
            frozenset(s[:2] for s in self.exact),
            frozenset(s[-2:] if s else "" for s in self.exact),
            all_of([self.query, _of_set(self.exact)]),
        )

    def small(self) -> "Part":
        p = self
        if p.exact is not None and (len(p.exact) > _MAX_SET or any(len(s) > 64 for s in p.exact)):
            p = p.folded()
        if p.exact is not None:
            return p
        query, ends = p.query, []
        for strings, cut in ((p.prefix, lambda s: s[:2]), (p.suffix, lambda s: s[-2:])):
            query = all_of([query, _of_set(strings)])
            short = frozenset(map(cut, strings))
            ends.append(short if len(short) <= _MAX_SET else frozenset({""}))
        return Part(None, ends[0], ends[1], query)


EMPTY = Part(frozenset({""}), frozenset({""}), frozenset({""}), True)
ANY = Part(None, frozenset({""}), frozenset({""}), True)


def _cross(a, b) -> frozenset:
    return frozenset(x + y for x in a for y in b)


def concat(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None:
        both = _cross(a.exact, b.exact)
        return Part(both, both, both, all_of([a.query, b.query])).small()
    prefix = _cross(a.exact, b.folded().prefix) if a.exact is not None else a.prefix
    suffix = _cross(a.folded().suffix, b.exact) if b.exact is not None else b.suffix
    # What lies over the border; the sides' own trigrams are in their queries.
    over = _cross(a.folded().suffix, b.folded().prefix)
    query = all_of([a.query, b.query, _of_set(over)])
    if a.exact is not None:
        query = all_of([query, a.folded().query])
    if b.exact is not None:
        query = all_of([query, b.folded().query])
    return Part(None, prefix, suffix, query).small()


def alternate(parts: list[Part]) -> Part:
    if all(p.exact is not None for p in parts):
        exact = frozenset().union(*(p.exact for p in parts))
        return Part(exact, exact, exact, any_of(p.query for p in parts)).small()
    parts = [p.folded() for p in parts]
    return Part(
        None,
        frozenset().union(*(p.prefix for p in parts)),
        frozenset().union(*(p.suffix for p in parts)),
        any_of(p.query for p in parts),
    ).small()


def _chars(items) -> Part:
    """A class of characters: exact when it has few."""
    found = set()
    for op, arg in items:
        op = str(op)
        if op == "LITERAL":
            found.add(chr(arg).lower())
        elif op == "RANGE" and arg[1] - arg[0] < _MAX_SET:
            found |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return ANY
    return Part(*(frozenset(found),) * 3, True).small() if len(found) <= _MAX_SET // 2 else ANY


def _walk(nodes) -> Part:
    out = EMPTY
    for op, arg in nodes:
        op = str(op)
        if op == "LITERAL":
            text = chr(arg).lower()
            part = Part(*(frozenset({text}),) * 3, True) if len(text) == 1 else ANY
        elif op == "IN":
            part = _chars(arg)
        elif op == "SUBPATTERN":
            part = _walk(arg[-1])
        elif op == "BRANCH":
            part = alternate([_walk(b) for b in arg[1]])
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg
            one = _walk(inner)
            if low == 0:
                part = alternate([EMPTY, one]) if int(high) == 1 else ANY
            else:
                part = one
                for _ in range(min(low, 8) - 1):
                    part = concat(part, one)
                if int(high) != low or low > 8:
                    # More may follow: what a match starts and ends with stays true.
                    f, g = part.folded(), one.folded()
                    part = Part(None, f.prefix, g.suffix, f.query)
        elif op in ("AT", "ASSERT", "ASSERT_NOT"):
            part = EMPTY
        else:
            part = ANY
        out = concat(out, part)
    return out


def trigram_query(pattern: str) -> object:
    """The query that the folded text of every match satisfies."""
    part = _walk(_parser.parse(pattern))
    return part.folded().small().query


def grams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(grams(p) for p in query[1]))


def holds(query: object, text: str) -> bool:
    """Whether a folded text satisfies the query."""
    if query is True:
        return True
    if isinstance(query, str):
        return query in text
    return (all if query[0] == "and" else any)(holds(p, text) for p in query[1])
