"""Term maps read backwards: which rows give a term, and which rows of two maps give the same.

A template is injective in a slot whose text is an integer or percent-encoded,
so a constant IRI becomes a test of the source columns, and two uses of one
template are compared by their columns.  Whatever cannot be decided that way is
compared by the built strings, which is always right.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote_to_bytes

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadspark.functions.scalars import ENCODE_FOR_URI
from quadspark.functions.terms import IRI, LITERAL
from quadspark.operators.termmaps import Constant, Reference, Template, TermMap, named, quoted

_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_INTEGER = r"0|-?[1-9][0-9]*"
_ENCODED = r"(?:[A-Za-z0-9._~\-]|%[0-9A-F]{2})*"
#: Characters that an encoded slot cannot hold: a piece that begins with another one leaves the slot's end open.
_INSIDE = re.compile(r"[A-Za-z0-9._~%\-]")
#: More ways than this to split a constant into slots are compared by the built string.
MAX_SPLITS = 16


def _pieces(template: Template) -> tuple[list[str], list[str]]:
    """The fixed texts of a template, and the columns between them."""
    parts = re.split(r"\{([^{}]+)\}", template.pattern)
    return parts[::2], parts[1::2]


def _integral(kind: T.DataType | None) -> bool:
    return type(kind) in _BITS


def _slot_pattern(template: Template, kind: T.DataType) -> str:
    if _integral(kind):
        return _INTEGER
    return r"(?s:.*)" if template.term_type == LITERAL else _ENCODED


def _splits(text: str, pieces: list[str], patterns: list[str]) -> Iterator[tuple[str, ...]]:
    """Every way to read the text as the pieces with a slot's text between each two."""
    if not text.startswith(pieces[0]):
        return
    rest = text[len(pieces[0]):]
    if not patterns:
        if not rest:
            yield ()
        return
    following = pieces[1]
    at = rest.find(following)
    while at >= 0:
        if re.fullmatch(patterns[0], rest[:at]):
            for tail in _splits(rest[at:], pieces[1:], patterns[1:]):
                yield rest[:at], *tail
        at = rest.find(following, at + 1)


def _slot_is(template: Template, types: dict[str, T.DataType], name: str, text: str) -> str | None:
    """Test of a column for giving this text in its slot."""
    column, kind = named(name), types[name]
    if _integral(kind):
        bound = 1 << (_BITS[type(kind)] - 1)
        return f"{column} = {int(text)}" if -bound <= int(text) < bound else None
    if template.term_type != LITERAL:
        try:
            plain = unquote_to_bytes(text).decode("utf-8")
        except UnicodeDecodeError:
            return None
        if quote(plain, safe="-._~") != text:
            return None
        if not isinstance(kind, T.StringType):
            return f"{ENCODE_FOR_URI.format(f'cast({column} AS string)')} = {quoted(text)}"
        text = plain
    return f"{column if isinstance(kind, T.StringType) else f'cast({column} AS string)'} = {quoted(text)}"


def equals(term_map: TermMap, types: dict[str, T.DataType], value: str) -> str | None:
    """SQL test of a row for giving this value; None if no row can."""
    if isinstance(term_map, Constant):
        return "true" if term_map.constant == value else None
    if isinstance(term_map, Reference):
        column, kind = named(term_map.column), types[term_map.column]
        if isinstance(kind, T.StringType):
            return f"{column} = {quoted(value)}"
        if _integral(kind):
            return _slot_is(Template(LITERAL, ""), types, term_map.column, value) if re.fullmatch(_INTEGER, value) else None
    if isinstance(term_map, Template):
        pieces, names = _pieces(term_map)
        found: list[str] = []
        for number, texts in enumerate(_splits(value, pieces, [_slot_pattern(term_map, types[n]) for n in names])):
            if number == MAX_SPLITS:
                return f"{term_map.sql(types)} = {quoted(value)}"
            tests = [_slot_is(term_map, types, n, t) for n, t in zip(names, texts, strict=True)]
            if None not in tests:
                found.append(" AND ".join(tests) or "true")
        return " OR ".join(f"({f})" for f in found) or None
    return f"{term_map.sql(types)} = {quoted(value)}"


def _separable(template: Template, types: dict[str, T.DataType]) -> bool:
    """Whether a built string can be split into its slots in one way only."""
    pieces, names = _pieces(template)
    for i, name in enumerate(names):
        following, last = pieces[i + 1], i == len(names) - 1
        if template.term_type == LITERAL and not _integral(types[name]):
            if len(names) > 1:
                return False
        elif not last and (not following or (re.match("[0-9]", following) if _integral(types[name]) else _INSIDE.match(following))):
            return False
    return True


def same(a: TermMap, a_types: dict[str, T.DataType], b: TermMap, b_types: dict[str, T.DataType]) -> list[str] | None:
    """SQL tests that two maps give the same value; None if they never do."""
    if isinstance(a, Constant):
        test = equals(b, b_types, a.constant)
        return None if test is None else [test]
    if isinstance(b, Constant):
        return same(b, b_types, a, a_types)
    if isinstance(a, Template) and isinstance(b, Template):
        (pieces, names), (others, other_names) = _pieces(a), _pieces(b)
        first, second, last, end = pieces[0], others[0], pieces[-1], others[-1]
        if not (first.startswith(second) or second.startswith(first)) or not (last.endswith(end) or end.endswith(last)):
            return None
        encoded = (a.term_type == LITERAL) == (b.term_type == LITERAL)
        if pieces == others and encoded and _separable(a, a_types) and _separable(b, b_types):
            return [_same_column(n, a_types[n], m, b_types[m]) for n, m in zip(names, other_names, strict=True)]
    if isinstance(a, Reference) and isinstance(b, Reference) and (kind := a_types[a.column]) == b_types[b.column]:
        if isinstance(kind, T.StringType) or _integral(kind):
            return [f"{named(a.column)} = {named(b.column)}"]
    return [f"{a.sql(a_types)} = {b.sql(b_types)}"]


def _same_column(a: str, a_kind: T.DataType, b: str, b_kind: T.DataType) -> str:
    alike = _integral(a_kind) and _integral(b_kind) or isinstance(a_kind, T.StringType) and isinstance(b_kind, T.StringType)
    return f"{named(a)} = {named(b)}" if alike else f"cast({named(a)} AS string) = cast({named(b)} AS string)"


def keys_of(iris: DataFrame, term_map: TermMap, types: dict[str, T.DataType]) -> tuple[DataFrame, list[str]] | None:
    """The source keys that IRIs (column ``s``) stand for under a template, and the columns they belong to.

    Keys come as ``__k0``, ``__k1``, ...; IRIs that the template cannot give are
    left out.  None if a built string does not tell its slots.
    """
    if not isinstance(term_map, Template) or term_map.term_type != IRI or not _separable(term_map, types):
        return None
    pieces, names = _pieces(term_map)
    if not names or len(set(names)) < len(names):
        return None
    if not all(_integral(types[n]) or isinstance(types[n], T.StringType) for n in names):
        return None
    pattern = "^" + re.escape(pieces[0]) + "".join(
        f"({_slot_pattern(term_map, types[n])}){re.escape(piece)}" for n, piece in zip(names, pieces[1:], strict=True)) + "$"
    given = iris.where(F.col("s").rlike(pattern))
    texts = [F.regexp_extract("s", pattern, i + 1) for i in range(len(names))]
    keys, legal = [], F.lit(True)
    for i, (name, text) in enumerate(zip(names, texts, strict=True)):
        if _integral(types[name]):
            key = text.try_cast(types[name])
            legal = legal & key.isNotNull()
        else:
            key = F.try_url_decode(text)
        keys.append(key.alias(f"__k{i}"))
    found = given.where(legal).select("s", *keys)
    for i, name in enumerate(names):
        if not _integral(types[name]):
            # Only the canonical encoding is what the template writes.
            found = found.where(F.regexp_extract("s", pattern, i + 1) == F.expr(ENCODE_FOR_URI.format(f"__k{i}")))
    return found.drop("s"), names
