"""Gates derived from patterns: which of many patterns can match a text at all, by one pass of an automaton.

Every way through a pattern is reduced to a set of literals of which a match must contain one. The literals
of all patterns go into one Aho-Corasick automaton; a pattern none of whose literals is in a text can't match it.
A pattern with a way through that needs no literal is always tried. So a gate never rejects what its pattern accepts.
"""

from __future__ import annotations

import re
from re import _constants as c
from re import _parser as parser

import ahocorasick

#: Shorter literals of ASCII characters tell too little.
SHORTEST = 3
#: Letters that lower-casing and case-blind matching treat differently; a text with one of them passes every gate.
_ODD_CASE = re.compile("[ſıİK]")


def needed(pattern: re.Pattern) -> frozenset[str] | None:
    """Literals (in lower case) of which each match of a pattern has one, or None if no such set is known."""
    return _of_sequence(parser.parse(pattern.pattern, pattern.flags & ~re.DEBUG))


def _of_sequence(sequence) -> frozenset[str] | None:
    """The best set among the parts of a sequence that every match goes through."""
    found: list[frozenset[str]] = []
    run = ""
    for op, value in [*sequence, (None, None)]:
        if op is c.LITERAL:
            run += chr(value).lower()
            continue
        if len(run) >= SHORTEST or not run.isascii():
            found.append(frozenset([run]))
        run = ""
        inner = None
        if op is c.SUBPATTERN:
            inner = _of_sequence(value[3])
        elif op is c.BRANCH:
            ways = [_of_sequence(way) for way in value[1]]
            inner = None if None in ways else frozenset().union(*ways)
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT) and value[0] >= 1:
            inner = _of_sequence(value[2])
        elif op is c.ATOMIC_GROUP:
            inner = _of_sequence(value)
        if inner:
            found.append(inner)
    return max(found, key=lambda s: (min(map(len, s)), -len(s)), default=None)


class Gate:
    """``may_match(text)``: the names of the patterns that can match a text, as a mask of ``bit[name]``."""

    def __init__(self, **patterns: re.Pattern):
        self.bit = {name: 1 << k for k, name in enumerate(patterns)}
        self.always = 0
        literals: dict[str, int] = {}
        for name, pattern in patterns.items():
            known = needed(pattern)
            if known is None:
                self.always |= self.bit[name]
            for literal in known or ():
                literals[literal] = literals.get(literal, 0) | self.bit[name]
        self.automaton = ahocorasick.Automaton()
        for literal, bits in literals.items():
            self.automaton.add_word(literal, bits)
        self.all = (1 << len(patterns)) - 1
        if literals:
            self.automaton.make_automaton()

    def may_match(self, text: str) -> int:
        found = self.always
        if not len(self.automaton) or _ODD_CASE.search(text):
            return self.all
        for _, bits in self.automaton.iter(text.lower()):
            found |= bits
        return found
