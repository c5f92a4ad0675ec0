"""Query-language scalar functions over terms.

Functions that yield a term return ``Term``; tests return a Boolean column that
is null on an error, so ``filter_`` drops the row.  All of them are built-in
expressions; casts are ``try_cast``, because a bad lexical form is an error
value and must not fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadspark.functions.terms import (
    BNODE,
    IRI,
    LITERAL,
    NUMERIC_TYPES,
    XSD_BOOLEAN,
    XSD_DATE,
    XSD_DATETIME,
    XSD_DAY_TIME_DURATION,
    XSD_DECIMAL,
    XSD_DOUBLE,
    XSD_FLOAT,
    XSD_INTEGER,
    XSD_STRING,
    Term,
    bnode_term,
    iri_term,
    known,
    lang_term,
    literal_term,
    null,
)

# Characters that may not occur in an IRI (fixed by the N-Triples grammar; a
# pipe, a backslash and a backtick are excluded as well).
ILLEGAL_IRI = r'[\x00-\x20<>"{}|^`\\]'


# --- plain column helpers ---------------------------------------------------

# ``url_encode`` writes HTML-form encoding; three characters differ.
ENCODE_FOR_URI = "replace(replace(replace(url_encode({}), '+', '%20'), '*', '%2A'), '%7E', '~')"


def encode_for_uri(value: Column) -> Column:
    """Percent-encode everything but unreserved characters."""
    encoded = F.url_encode(value)
    for form, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(form), F.lit(wanted))
    return encoded


def valid_iri(value: Column) -> Column:
    """The value, or null if it cannot be an IRI."""
    return F.when((value != "") & ~value.rlike(ILLEGAL_IRI), value)


def concat_terms(*values: Column) -> Column:
    """``CONCAT`` on lexical forms: null if an argument is unbound."""
    return F.concat(*values)


# --- terms ------------------------------------------------------------------

def str_(t: Term) -> Term:
    return literal_term(F.when(t.kind != BNODE, t.value))


def lang(t: Term) -> Term:
    return literal_term(F.when(t.kind == LITERAL, F.coalesce(t.lang, F.lit(""))))


def datatype(t: Term) -> Term:
    return iri_term(F.when(t.kind == LITERAL, t.dt))


def iri(value: Term | Column) -> Term:
    """``IRI``: the string as an IRI, unbound if it is not a legal one."""
    if isinstance(value, Term):
        value = F.when(value.kind != BNODE, value.value)
    return iri_term(valid_iri(value))


def is_iri(t: Term) -> Column:
    return t.kind == IRI


def is_blank(t: Term) -> Column:
    return t.kind == BNODE


def is_literal(t: Term) -> Column:
    return t.kind == LITERAL


def is_numeric(t: Term) -> Column:
    return known(t.value, F.coalesce(double(t).isNotNull(), F.lit(False)))


def same_term(a: Term, b: Term) -> Column:
    same = (a.value == b.value) & (a.kind == b.kind)
    return same & a.dt.eqNullSafe(b.dt) & a.lang.eqNullSafe(b.lang)


def _canonical(t: Term) -> Column:
    """One form of equal integers and decimals, whatever their length; null for other terms."""
    plain = F.regexp_replace(F.regexp_replace(t.value, r"^\+", ""), r"^(-?)0+(?=\d)", "$1")
    short = F.when(F.contains(plain, F.lit(".")), F.regexp_replace(plain, r"\.?0*$", "")).otherwise(plain)
    padded = F.regexp_replace(short, r"^(-?)(?=\.|$)", "$10")
    exact = t.dt.isin(NUMERIC_TYPES) & ~t.dt.isin(XSD_DOUBLE, XSD_FLOAT) & t.value.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)$")
    return F.when(exact, F.when(padded == "-0", "0").otherwise(padded))


def equals(a: Term, b: Term) -> Column:
    """``=``: equal terms, or numbers of equal value; integers and decimals compare exactly."""
    x, y = double(a), double(b)
    p, q = _canonical(a), _canonical(b)
    return F.when(p.isNotNull() & q.isNotNull(), p == q).when(
        x.isNotNull() & y.isNotNull(), x == y).otherwise(same_term(a, b))


# --- typed values -----------------------------------------------------------

def double(t: Term) -> Column:
    """Numeric value as DOUBLE, null if the term is not a number."""
    return F.when(t.dt.isin(NUMERIC_TYPES), t.value.try_cast("double"))


def decimal(t: Term) -> Column:
    return F.when(t.dt.isin(NUMERIC_TYPES), t.value.try_cast("decimal(38,18)"))


def integer(t: Term) -> Column:
    return F.when(t.dt.isin(NUMERIC_TYPES), t.value.try_cast("bigint"))


def boolean(t: Term) -> Column:
    return F.when(
        t.dt == XSD_BOOLEAN,
        F.when(t.value.isin("true", "1"), True).when(t.value.isin("false", "0"), False),
    )


def date(t: Term) -> Column:
    return F.when(t.dt.isin(XSD_DATE, XSD_DATETIME), F.substring(t.value, 1, 10).try_cast("date"))


def timestamp(t: Term) -> Column:
    """Instant of an ``xsd:dateTime``; without a zone, that of the session."""
    return F.when(t.dt == XSD_DATETIME, t.value.try_cast("timestamp"))


def number_term(value: Column, dt: str) -> Term:
    return literal_term(value.cast("string"), dt)


# --- logic ------------------------------------------------------------------

def if_(cond: Column, a: Term, b: Term) -> Term:
    def pick(x: Column, y: Column) -> Column:
        return F.when(cond, x).when(~cond, y)

    return Term(pick(a.value, b.value), pick(a.kind, b.kind), pick(a.dt, b.dt), pick(a.lang, b.lang))


def coalesce_terms(*terms: Term) -> Term:
    """First bound term; the companions follow the chosen value."""
    def first(part: str) -> Column:
        chosen = F.when(terms[0].value.isNotNull(), getattr(terms[0], part))
        for t in terms[1:]:
            chosen = chosen.when(t.value.isNotNull(), getattr(t, part))
        return chosen

    return Term(F.coalesce(*(t.value for t in terms)), first("kind"), first("dt"), first("lang"))


def bound(t: Term) -> Column:
    return t.value.isNotNull()


def in_(t: Term, *others: Term) -> Column:
    result = F.lit(False)
    for other in others:
        result = result | equals(t, other)
    return result


def not_in(t: Term, *others: Term) -> Column:
    return ~in_(t, *others)


# --- strings ----------------------------------------------------------------

def text(t: Term) -> Column:
    """The value of a string literal, with or without a language; else null."""
    return F.when((t.dt == XSD_STRING) | t.lang.isNotNull(), t.value)


def like(t: Term, value: Column) -> Term:
    """A string with the datatype and language of ``t``."""
    return Term(value, known(value, LITERAL), known(value, t.dt), known(value, t.lang))


def strlen(t: Term) -> Term:
    return number_term(F.length(text(t)), XSD_INTEGER)


def substr(t: Term, start: int, length: int | None = None) -> Term:
    """``SUBSTR``; positions count from 1."""
    size = F.length(text(t)) if length is None else F.lit(length)
    return like(t, F.substr(text(t), F.lit(start), size))


def ucase(t: Term) -> Term:
    return like(t, F.upper(text(t)))


def lcase(t: Term) -> Term:
    return like(t, F.lower(text(t)))


def strstarts(t: Term, prefix: str) -> Column:
    return F.startswith(text(t), F.lit(prefix))


def strends(t: Term, suffix: str) -> Column:
    return F.endswith(text(t), F.lit(suffix))


def contains(t: Term, part: str) -> Column:
    return F.contains(text(t), F.lit(part))


def strbefore(t: Term, mark: str) -> Term:
    """``STRBEFORE``; without a match a plain empty string."""
    value = text(t)
    found = F.contains(value, F.lit(mark))
    before = F.substr(value, F.lit(1), F.instr(value, mark) - 1)
    return if_(found, like(t, before), literal_term(F.lit("")))


def strafter(t: Term, mark: str) -> Term:
    value = text(t)
    found = F.contains(value, F.lit(mark))
    after = F.substr(value, F.instr(value, mark) + len(mark), F.length(value))
    return if_(found, like(t, after), literal_term(F.lit("")))


def concat(*terms: Term) -> Term:
    """``CONCAT`` of strings; a language is kept only if all arguments share it."""
    value = F.concat(*(text(t) for t in terms))
    shared = terms[0].lang
    for t in terms[1:]:
        shared = F.when(shared == t.lang, shared)
    plain = literal_term(value)
    tagged = lang_term(F.when(shared.isNotNull(), value), shared)
    return coalesce_terms(tagged, plain)


def regex(t: Term, pattern: str, flags: str = "") -> Column:
    return text(t).rlike(_pattern(pattern, flags))


def replace(t: Term, pattern: str, replacement: str, flags: str = "") -> Term:
    return like(t, F.regexp_replace(text(t), _pattern(pattern, flags), replacement))


def _pattern(pattern: str, flags: str) -> str:
    return f"(?{flags}){pattern}" if flags else pattern


def langmatches(t: Term, wanted: str) -> Column:
    """``LANGMATCHES(LANG(t), wanted)``: the tag or a sub-tag; ``*`` is any tag."""
    tag = F.coalesce(F.lower(t.lang), F.lit(""))
    if wanted == "*":
        return known(t.dt, tag != "")
    wanted = wanted.lower()
    return known(t.dt, (tag == wanted) | F.startswith(tag, F.lit(wanted + "-")))


def encode(t: Term) -> Term:
    """``ENCODE_FOR_URI`` of a string literal."""
    return literal_term(encode_for_uri(text(t)))


# --- numbers ----------------------------------------------------------------

def abs_(t: Term) -> Term:
    return _numeric(t, F.abs, F.abs)


def ceil(t: Term) -> Term:
    return _numeric(t, F.ceil, F.ceil)


def floor(t: Term) -> Term:
    return _numeric(t, F.floor, F.floor)


def round_(t: Term) -> Term:
    """``ROUND``: halves go up, also below zero."""
    return _numeric(t, lambda x: F.floor(x + 0.5), lambda x: F.floor(x + F.lit("0.5").cast("decimal(2,1)")))


def _numeric(t: Term, on_double, on_decimal) -> Term:
    """Apply a function in the arithmetic of the datatype; the datatype is kept."""
    floating = t.dt.isin(XSD_DOUBLE, XSD_FLOAT)
    value = F.when(floating, on_double(double(t)).cast("double").cast("string")).otherwise(
        _trim_zeros(on_decimal(decimal(t)).cast("decimal(38,18)").cast("string"))
    )
    return Term(value, known(value, LITERAL), known(value, t.dt), null())


def _trim_zeros(value: Column) -> Column:
    return F.regexp_replace(value, r"\.0+$|(?<=\.\d{0,17}[1-9])0+$", "")


def rand() -> Term:
    return number_term(F.rand(), XSD_DOUBLE)


# --- dates ------------------------------------------------------------------
# The parts are read off the lexical form: SPARQL gives them in the zone the
# literal states, not in that of the session.

_DATETIME = r"^(-?\d{4,})-(\d\d)-(\d\d)T(\d\d):(\d\d):(\d\d(?:\.\d+)?)(Z|[+-]\d\d:\d\d)?$"


def _part(t: Term, group: int) -> Column:
    value = F.when((t.dt == XSD_DATETIME) & t.value.rlike(_DATETIME), t.value)
    return F.regexp_extract(value, _DATETIME, group)


def now() -> Term:
    return literal_term(
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        XSD_DATETIME,
    )


def year(t: Term) -> Term:
    return number_term(_part(t, 1).cast("bigint"), XSD_INTEGER)


def month(t: Term) -> Term:
    return number_term(_part(t, 2).cast("bigint"), XSD_INTEGER)


def day(t: Term) -> Term:
    return number_term(_part(t, 3).cast("bigint"), XSD_INTEGER)


def hours(t: Term) -> Term:
    return number_term(_part(t, 4).cast("bigint"), XSD_INTEGER)


def minutes(t: Term) -> Term:
    return number_term(_part(t, 5).cast("bigint"), XSD_INTEGER)


def seconds(t: Term) -> Term:
    return literal_term(F.regexp_replace(_part(t, 6), r"^0(?=\d)", ""), XSD_DECIMAL)


def tz(t: Term) -> Term:
    return literal_term(_part(t, 7))


def timezone(t: Term) -> Term:
    """The zone as a duration; unbound where a literal states none."""
    zone = _part(t, 7)
    hour, minute = F.substring(zone, 2, 2).cast("int"), F.substring(zone, 5, 2).cast("int")
    parts = F.concat(F.when(hour > 0, F.concat(hour.cast("string"), F.lit("H"))).otherwise(""),
                     F.when(minute > 0, F.concat(minute.cast("string"), F.lit("M"))).otherwise(""))
    signed = F.concat(F.when(F.startswith(zone, F.lit("-")), F.lit("-")).otherwise(""), F.lit("PT"), parts)
    return literal_term(F.when(zone.isin("Z", "+00:00", "-00:00"), "PT0S").when(zone != "", signed), XSD_DAY_TIME_DURATION)


# --- hashes and constructors --------------------------------------------------

def md5(t: Term) -> Term:
    return literal_term(F.md5(text(t)))


def sha1(t: Term) -> Term:
    return literal_term(F.sha1(text(t)))


def sha256(t: Term) -> Term:
    return literal_term(F.sha2(text(t), 256))


def sha384(t: Term) -> Term:
    return literal_term(F.sha2(text(t), 384))


def sha512(t: Term) -> Term:
    return literal_term(F.sha2(text(t), 512))


def strdt(t: Term, dt: str) -> Term:
    return literal_term(F.when(t.dt == XSD_STRING, t.value), dt)


def strlang(t: Term, tag: str) -> Term:
    return lang_term(F.when(t.dt == XSD_STRING, t.value), tag)


def uuid() -> Term:
    return iri_term(F.concat(F.lit("urn:uuid:"), F.uuid()))


def struuid() -> Term:
    return literal_term(F.uuid())


def bnode(*keys: Column) -> Term:
    """A blank node labelled by a hash of its keys, so that a retry makes the same one."""
    parts = [F.coalesce(k.cast("string"), F.lit("\u0000")) for k in keys]
    return bnode_term(F.concat(F.lit("b"), F.sha2(F.concat_ws("\u0001", *parts), 256)))


def env_param(env: dict[str, str], name: str) -> Term:
    """A run parameter as an IRI constant."""
    if name not in env:
        raise KeyError(f"parameter {name} is not set")
    return iri_term(F.lit(env[name]))
