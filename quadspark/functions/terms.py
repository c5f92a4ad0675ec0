"""RDF terms as flat columns.

A triple has the columns ``s, s_kind, p, o, o_kind, o_dt, o_lang``; a quad adds
``g`` (null is the default graph).  A kind is ``iri``, ``bnode`` or
``literal``.  Values keep their lexical form as strings; a literal always has a
datatype, and a language tag only with ``rdf:langString``.

In a solution, variable ``x`` is the column ``x`` with the companions
``x_kind`` and, where it may be a literal, ``x_dt`` and ``x_lang``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
RDF_TYPE = RDF + "type"
LANG_STRING = RDF + "langString"
XSD_STRING = XSD + "string"
XSD_INTEGER = XSD + "integer"
XSD_DECIMAL = XSD + "decimal"
XSD_DOUBLE = XSD + "double"
XSD_FLOAT = XSD + "float"
XSD_BOOLEAN = XSD + "boolean"
XSD_DATE = XSD + "date"
XSD_DATETIME = XSD + "dateTime"
XSD_DAY_TIME_DURATION = XSD + "dayTimeDuration"
NUMERIC_TYPES = [
    XSD + name
    for name in (
        "integer", "decimal", "double", "float", "byte", "short", "int", "long",
        "unsignedByte", "unsignedShort", "unsignedInt", "unsignedLong",
        "nonNegativeInteger", "nonPositiveInteger", "negativeInteger", "positiveInteger",
    )
]

IRI = "iri"
BNODE = "bnode"
LITERAL = "literal"

TRIPLE_COLUMNS = ["s", "s_kind", "p", "o", "o_kind", "o_dt", "o_lang"]
QUAD_COLUMNS = [*TRIPLE_COLUMNS, "g"]
TRIPLE_SCHEMA = ", ".join(f"{c} string" for c in TRIPLE_COLUMNS)
QUAD_SCHEMA = ", ".join(f"{c} string" for c in QUAD_COLUMNS)

SUFFIXES = ("_kind", "_dt", "_lang")


@dataclass(frozen=True)
class Literal:
    """A constant literal in a pattern or template."""

    value: str
    dt: str = XSD_STRING
    lang: str | None = None

    @property
    def datatype(self) -> str:
        return LANG_STRING if self.lang else self.dt


@dataclass(frozen=True)
class Term:
    """One term as four columns; every scalar function maps terms to terms."""

    value: Column
    kind: Column
    dt: Column
    lang: Column

    def columns(self, name: str) -> list[Column]:
        """The columns of this term as solution variable ``name``."""
        parts = (self.value, self.kind, self.dt, self.lang)
        return [c.alias(name + suffix) for c, suffix in zip(parts, ("", *SUFFIXES), strict=True)]


def null() -> Column:
    return F.lit(None).cast("string")


def known(value: Column, other: str | Column) -> Column:
    """``other`` where the value is bound, so that an unbound term is null throughout."""
    return F.when(value.isNotNull(), F.lit(other) if isinstance(other, str) else other)


def iri_term(value: Column) -> Term:
    return Term(value, known(value, IRI), null(), null())


def bnode_term(value: Column) -> Term:
    return Term(value, known(value, BNODE), null(), null())


def literal_term(value: Column, dt: str | Column = XSD_STRING) -> Term:
    return Term(value, known(value, LITERAL), known(value, dt), null())


def lang_term(value: Column, lang: str | Column) -> Term:
    tag = F.lower(F.lit(lang) if isinstance(lang, str) else lang)
    return Term(value, known(value, LITERAL), known(value, LANG_STRING), known(value, tag))


def constant(value: str | Literal) -> Term:
    """A plain string is an IRI; a literal is given as ``Literal``."""
    if isinstance(value, Literal):
        return Term(
            F.lit(value.value), F.lit(LITERAL), F.lit(value.datatype),
            F.lit(value.lang.lower()) if value.lang else null(),
        )
    return Term(F.lit(value), F.lit(IRI), null(), null())


def term(sol: DataFrame, name: str) -> Term:
    """Variable ``name`` of a solution as a term."""
    columns = set(sol.columns)
    if name not in columns:
        raise ValueError(f"no variable {name} in {sorted(variables(sol))}")
    value = F.col(name)
    if f"{name}_kind" not in columns:
        return literal_term(value.cast("string"))
    if f"{name}_dt" not in columns:
        return Term(value, F.col(f"{name}_kind"), null(), null())
    return Term(value, *(F.col(name + suffix) for suffix in SUFFIXES))


def object_term() -> Term:
    """The object columns of a triple DataFrame as a term."""
    return Term(F.col("o"), F.col("o_kind"), F.col("o_dt"), F.col("o_lang"))


def variables(sol: DataFrame) -> list[str]:
    """The variables of a solution, without their companion columns."""
    columns = set(sol.columns)
    companions = {name + suffix for name in columns for suffix in SUFFIXES}
    return [c for c in sol.columns if c not in companions]


def columns_of(sol: DataFrame, name: str) -> list[str]:
    """The column ``name`` and the companions present."""
    present = set(sol.columns)
    return [c for c in (name, *(name + suffix for suffix in SUFFIXES)) if c in present]


def term_key(name: str, present: Iterable[str] = SUFFIXES) -> Column:
    """A whole term as one string, for distinct counts.

    The value comes last and the other parts hold no separator, so different
    terms have different keys.  A string groups much faster than a struct.
    """
    parts = [F.coalesce(F.col(name + suffix), F.lit("")) for suffix in SUFFIXES if suffix in present]
    return F.concat_ws("\u0001", *parts, F.col(name))


def maybe_unbound(sol: DataFrame, name: str) -> bool:
    """Whether the variable was marked as possibly unbound by an earlier operator."""
    return bool(sol.schema[name].metadata.get("unbound", False))


def mark_unbound(sol: DataFrame, names: Iterable[str]) -> DataFrame:
    """Mark variables as possibly unbound.

    The mark is column metadata, which Spark carries through filters, joins and
    projections; ``join`` and ``minus`` read it to choose equi-joins.
    """
    marked = set(names)
    if not marked:
        return sol
    return sol.select(*(
        F.col(c).alias(c, metadata={"unbound": True}) if c in marked else F.col(c)
        for c in sol.columns
    ))


def as_quads(df: DataFrame) -> DataFrame:
    """Bring triples or quads to the quad columns."""
    g = F.col("g") if "g" in df.columns else null().alias("g")
    return df.select(*TRIPLE_COLUMNS, g)
