"""A small parsing-expression grammar engine.

Expressions are matched by recursive descent with ordered choice. Terminals are
regular expressions, so runs of plain text cost one step. A match gives
(end, tree); a named rule gives a node (name, start, end, children), everything
else splices its children into the rule around it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

Match = tuple[int, list] | None
Parser = Callable[[str, int], Match]


def term(pattern: str, flags: int = 0) -> Parser:
    rx = re.compile(pattern, flags).match

    def parse(s: str, i: int) -> Match:
        m = rx(s, i)
        return (m.end(), []) if m else None

    return parse


def seq(*parts: Parser) -> Parser:
    def parse(s: str, i: int) -> Match:
        out: list = []
        for p in parts:
            m = p(s, i)
            if m is None:
                return None
            i = m[0]
            out += m[1]
        return i, out

    return parse


def first(*parts: Parser) -> Parser:
    def parse(s: str, i: int) -> Match:
        for p in parts:
            m = p(s, i)
            if m is not None:
                return m
        return None

    return parse


def many(p: Parser) -> Parser:
    def parse(s: str, i: int) -> Match:
        out: list = []
        while True:
            m = p(s, i)
            if m is None or m[0] == i:
                return i, out
            i = m[0]
            out += m[1]

    return parse


def maybe(p: Parser) -> Parser:
    def parse(s: str, i: int) -> Match:
        return p(s, i) or (i, [])

    return parse


def absent(p: Parser) -> Parser:
    def parse(s: str, i: int) -> Match:
        return (i, []) if p(s, i) is None else None

    return parse


def rule(name: str, p: Parser) -> Parser:
    def parse(s: str, i: int) -> Match:
        m = p(s, i)
        return None if m is None else (m[0], [(name, i, m[0], m[1])])

    return parse


def later(get: Callable[[], Parser]) -> Parser:
    """A rule that is defined further down, for recursion."""
    return lambda s, i: get()(s, i)


def switch(table: dict[str, Parser], default: Parser) -> Parser:
    """Ordered choice that looks at the next character first: the alternatives
    of ``table`` can only begin with their character; what they refuse, and the
    rest, goes to ``default``."""

    def parse(s: str, i: int) -> Match:
        p = table.get(s[i : i + 1])
        return (p(s, i) if p is not None else None) or default(s, i)

    return parse
