"""Term maps: how a row of a source gives a term."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

from quadspark.functions.scalars import ENCODE_FOR_URI
from quadspark.functions.terms import IRI, LITERAL
from quadspark.functions.terms import Literal as LiteralValue

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_PLACEHOLDER = re.compile(r"\{([^{}]+)\}")


# A term map gives the SQL text of its value: a whole source then needs one
# projection to be built, however many object maps it has.

def quoted(text: str) -> str:
    """A string as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(column: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + column.replace("`", "``") + "`"


@dataclass(frozen=True)
class TermMap:
    """Yields a lexical value from a row, and the kind of term it becomes."""

    term_type: str = LITERAL

    def references(self) -> list[str]:
        return []

    def sql(self, types: dict[str, T.DataType]) -> str:
        raise NotImplementedError


@dataclass(frozen=True)
class Template(TermMap):
    pattern: str = ""

    def references(self) -> list[str]:
        return _PLACEHOLDER.findall(self.pattern)

    def sql(self, types: dict[str, T.DataType]) -> str:
        parts = []
        for index, piece in enumerate(_PLACEHOLDER.split(self.pattern)):
            if index % 2:
                parts.append(self._slot(types, piece))
            elif piece:
                parts.append(quoted(piece))
        return f"concat({', '.join(parts)})"

    def _slot(self, types: dict[str, T.DataType], name: str) -> str:
        value = f"cast({named(name)} AS string)"
        # Digits and a minus sign are unreserved: keys need no encoding.
        if self.term_type == LITERAL or isinstance(types[name], _INTEGRAL):
            return value
        return ENCODE_FOR_URI.format(value)


@dataclass(frozen=True)
class Constant(TermMap):
    constant: str = ""

    def sql(self, types: dict[str, T.DataType]) -> str:
        return quoted(self.constant)


def lexical(value: str, kind: T.DataType | None) -> str:
    """SQL for the lexical form that the XML Schema type of a column's type has."""
    text = f"cast({value} AS string)"
    if isinstance(kind, T.TimestampNTZType):
        return f"replace({text}, ' ', 'T')"
    if isinstance(kind, T.TimestampType):
        utc = f"convert_timezone(current_timezone(), 'UTC', cast({value} AS timestamp_ntz))"
        return f"concat(replace(cast({utc} AS string), ' ', 'T'), 'Z')"
    if isinstance(kind, T.DoubleType | T.FloatType):
        return f"replace({text}, 'Infinity', 'INF')"
    if isinstance(kind, T.BinaryType):
        return f"hex({value})"
    return text


@dataclass(frozen=True)
class Reference(TermMap):
    column: str = ""

    def references(self) -> list[str]:
        return [self.column]

    def sql(self, types: dict[str, T.DataType]) -> str:
        return lexical(named(self.column), types.get(self.column))


@dataclass(frozen=True)
class Expression(TermMap):
    """A SQL expression over the source as a term map (the functions part of a mapping)."""

    text: str = ""

    def sql(self, types: dict[str, T.DataType]) -> str:
        return f"cast({self.text} AS string)"


def template(pattern: str, term_type: str = IRI) -> Template:
    """``{column}`` slots in a pattern; a null column gives no term.

    In IRIs and blank nodes the inserted values are percent-encoded down to
    ASCII unreserved characters; non-ASCII letters are encoded as well.
    """
    return Template(term_type, pattern)


def constant(value: str | LiteralValue, term_type: str = IRI) -> Constant:
    if isinstance(value, LiteralValue):
        return Constant(LITERAL, value.value)
    return Constant(term_type, value)


def reference(column: str, term_type: str = LITERAL) -> Reference:
    return Reference(term_type, column)


def expression(sql: str, term_type: str = LITERAL) -> Expression:
    return Expression(term_type, sql)
