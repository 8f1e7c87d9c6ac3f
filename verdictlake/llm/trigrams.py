"""Boolean trigram queries from regular expressions.

The query of a regex holds for every text that has a match: any of its sets of
trigrams, in lower case, must be there whole. It is read off the parsed regex:
parts that stand for few strings are joined to strings, whose trigrams a match
must hold; alternatives give alternatives; parts that may be missing, or stand
for very many strings, end a string and demand nothing.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from collections.abc import Iterable

FEW = 64
CLASS_FEW = 8

Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset({frozenset()})


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def least(query: Iterable[frozenset[str]]) -> Query:
    """The query without alternatives that another one implies."""
    sets = set(query)
    return frozenset(s for s in sets if not any(other < s for other in sets))


def both(one: Query, other: Query) -> Query:
    """Both must hold; a query of too many alternatives demands the first alone."""
    if len(one) * len(other) > FEW:
        return one if one != ANYTHING else other
    return least(a | b for a in one for b in other)


def any_of(strings: Iterable[str]) -> Query:
    return least(map(trigrams, strings))


def letters(items: list) -> set[str] | None:
    """The lower-case forms of a class of few ASCII characters, else None."""
    found: set[str] = set()
    for kind, value in items:
        codes = [value] if kind is sre.LITERAL else range(value[0], value[1] + 1) if kind is sre.RANGE else None
        if codes is None or max(codes) > 127:
            return None
        found |= {chr(c).lower() for c in codes}
    return found if len(found) <= CLASS_FEW else None


def strings_and_query(kind, value) -> tuple[set[str] | None, Query]:
    """The strings a part stands for if they are few, and what it demands."""
    if kind is sre.LITERAL:
        return ({chr(value).lower()}, ANYTHING) if value < 128 else (None, ANYTHING)
    if kind is sre.IN:
        found = letters(value)
        return found, ANYTHING
    if kind is sre.AT or kind in (sre.ASSERT, sre.ASSERT_NOT):
        return {""}, ANYTHING
    if kind is sre.SUBPATTERN:
        return sequence(value[-1])
    if kind is sre.ATOMIC_GROUP:
        return sequence(value)
    if kind is sre.BRANCH:
        parts = [sequence(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in parts) and sum(len(strings) for strings, _ in parts) <= FEW:
            return set().union(*(strings for strings, _ in parts)), ANYTHING
        return None, least(s for strings, query in parts for s in (query if strings is None else any_of(strings)))
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, inner = value
        strings, query = sequence(inner)
        if strings is not None and high is not sre.MAXREPEAT and len(strings) ** high <= FEW and high <= FEW:
            grown, every = {""}, {""} if low == 0 else set()
            for n in range(1, high + 1):
                grown = {a + b for a in grown for b in strings}
                every |= grown if n >= low else set()
            if len(every) <= FEW:
                return every, ANYTHING
        if low == 0:
            return None, ANYTHING
        return None, query if strings is None else any_of(a * low for a in strings) if len(strings) == 1 else any_of(strings)
    return None, ANYTHING  # any character, references: nothing is known


def sequence(parts) -> tuple[set[str] | None, Query]:
    """The same for parts one after the other."""
    strings, query, cut = {""}, ANYTHING, False
    for kind, value in parts:
        own, demanded = strings_and_query(kind, value)
        if own is not None and len(strings) * len(own) <= FEW:
            strings = {a + b for a in strings for b in own}
            continue
        query, cut = both(query, any_of(strings)), True
        strings = own if own is not None else {""}
        query = both(query, demanded)
    return (None, both(query, any_of(strings))) if cut else (strings, ANYTHING)


def trigram_query(regex: str) -> list[frozenset[str]]:
    """The sets of trigrams of which every match holds one; none if the regex
    has a match without any trigram that must be there."""
    strings, query = sequence(parser.parse(regex))
    query = any_of(strings) if strings is not None else query
    return [] if frozenset() in query else sorted(query, key=sorted)
