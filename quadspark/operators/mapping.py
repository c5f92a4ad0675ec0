"""Map tables to triples with declarative triples maps.

A mapping is a Python value.  Each source is scanned once: its object maps
become one array that is exploded into rows, so that neither the scan nor the
subject template is repeated per predicate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadspark.functions.terms import (
    IRI,
    LANG_STRING,
    LITERAL,
    QUAD_SCHEMA,
    RDF_TYPE,
    XSD_STRING,
)
from quadspark.functions.terms import Literal as LiteralValue
from quadspark.operators.inversion import equals
from quadspark.operators.termmaps import (  # noqa: F401
    Constant,
    Expression,
    Reference,
    Template,
    TermMap,
    constant,
    expression,
    named,
    quoted,
    reference,
    template,
)

# --- triples maps -------------------------------------------------------------

@dataclass(frozen=True)
class ParentRef:
    """An object that is the subject of another map, found by join conditions.

    All conditions have to hold.  Without any, parent and child are one row of
    one source.
    """

    parent: "TriplesMap"
    joins: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class ObjectMap:
    predicate: str | TermMap
    object: TermMap | ParentRef
    datatype: str | None = None
    language: str | TermMap | None = None


@dataclass(frozen=True)
class TriplesMap:
    """How the rows of a source become triples.

    ``unique`` tells that no two rows have the same subject: patterns on one
    subject are then answered from one row, without a join.
    """

    source: str
    subject: TermMap
    objects: Sequence[ObjectMap] = ()
    classes: Sequence[str] = ()
    graph: TermMap | None = None
    missing_reference: str = "error"
    unique: bool = False

    def __post_init__(self):
        if self.missing_reference not in ("error", "skip"):
            raise ValueError("missing_reference is 'error' or 'skip'")


def parent_ref(parent: TriplesMap, child: str | Sequence[str] = (), parent_key: str | Sequence[str] = ()) -> ParentRef:
    """Join conditions as one column of each side, or as equally many."""
    sides = [[x] if isinstance(x, str) else list(x) for x in (child, parent_key)]
    return ParentRef(parent, tuple(zip(*sides, strict=True)))


def pom(
    predicate: str | TermMap,
    obj: str | TermMap | ParentRef | LiteralValue,
    datatype: str | None = None,
    language: str | TermMap | None = None,
    term_type: str | None = None,
) -> ObjectMap:
    """A predicate-object map; a plain string object is a column reference.

    ``predicate`` is an IRI, or a term map that gives the predicate of each row.
    ``language`` is a tag or a term map that gives the tag of each row.
    """
    if isinstance(obj, LiteralValue):
        return ObjectMap(predicate, constant(obj), obj.datatype, obj.lang)
    if isinstance(obj, str):
        obj = reference(obj, term_type or LITERAL)
    return ObjectMap(predicate, obj, datatype, language)


def apply_mapping(
    df: DataFrame,
    triples_map: TriplesMap,
    sources: dict[str, DataFrame] | None = None,
    only: Iterable[str] | None = None,
    subject_parts: int | None = None,
) -> DataFrame:
    """Quads of one source.

    ``subject_parts`` deals the rows by their subject to so many tasks.
    ``only`` names the predicates wanted.  Catalyst cannot move a filter on the
    generated predicate below the generator, so the object maps are dropped here
    and their columns are never read.
    """
    mapped = _map_source(df, [triples_map], sources or {}, None if only is None else set(only), subject_parts=subject_parts)
    return df.sparkSession.createDataFrame([], QUAD_SCHEMA) if mapped is None else mapped


def apply_mappings(
    sources: dict[str, DataFrame],
    maps: Sequence[TriplesMap],
    only: Iterable[str] | None = None,
    s: str | None = None,
    o: str | LiteralValue | None = None,
) -> DataFrame:
    """Quads of several maps; the maps on one source share one scan.

    ``s`` and ``o`` leave out rows that cannot give this subject IRI or object;
    other quads of the rows that can may remain.  The result is a bag: rows that map to the same triple repeat it.  Sources
    with unique keys give a set; otherwise apply ``graph_union``.
    """
    wanted = None if only is None else set(only)
    by_source: dict[str, list[TriplesMap]] = {}
    for m in maps:
        by_source.setdefault(m.source, []).append(m)
    results = [_map_source(sources[name], group, sources, wanted, s, o) for name, group in by_source.items()]
    results = [r for r in results if r is not None]
    if not results:
        return next(iter(sources.values())).sparkSession.createDataFrame([], QUAD_SCHEMA)
    return reduce(lambda x, y: x.unionByName(y), results)


@dataclass(frozen=True)
class MappedGraph:
    """Tables with their mapping: a graph that is computed when it is queried.

    Pattern operators take it in place of a quad DataFrame and pass the constant
    predicates on, so that only the columns of those predicates are scanned.
    """

    sources: dict[str, DataFrame]
    maps: Sequence[TriplesMap]
    #: Redistributes the rows of a source (by name) before they are multiplied into quads.
    spread: Callable[[str, DataFrame], DataFrame] | None = None

    def quads_by_subject(self, parts: int, only: Iterable[str] | None = None) -> DataFrame:
        """All quads, or those with the predicates given; those of a subject are in one of as many tasks.

        Rows of the sources are moved before they are multiplied; what groups by the subject then needs no
        further shuffle.  For subjects of few rows: those of one subject stay in one task.
        """
        if len({m.source for m in self.maps}) < len(self.maps) or any(
                isinstance(om.object, ParentRef) for m in self.maps for om in m.objects):
            raise ValueError("quads by subject need one map for a source, and objects of the same row")
        only = None if only is None else set(only)
        return reduce(lambda x, y: x.unionByName(y), (
            apply_mapping(self.sources[m.source], m, only=only, subject_parts=parts) for m in self.maps))

    def quads(
        self, only: Iterable[str] | None = None, s: str | None = None, o: str | LiteralValue | None = None
    ) -> DataFrame:
        """All quads, or at least those with the predicates, the subject IRI and the object given.

        Subject and object become tests of the source columns, which the scan
        can use; maps that cannot give them are not read.
        """
        sources = self.sources
        if self.spread is not None and s is None and o is None:
            sources = {name: self.spread(name, df) for name, df in sources.items()}
        return apply_mappings(sources, self.maps, only, s, o)


@dataclass(frozen=True)
class GraphBySubject:
    """A mapped graph whose quads are dealt by subject to so many tasks, for operators that group by subject."""

    graph: MappedGraph
    parts: int

    def quads(self, only: Iterable[str] | None = None) -> DataFrame:
        return self.graph.quads_by_subject(self.parts, only)


def _map_source(df, maps, sources, only, wanted_s=None, wanted_o=None, subject_parts=None):
    def subject_test(m: TriplesMap) -> str | None:
        if wanted_s is None:
            return "true"
        return equals(m.subject, types, wanted_s) if subject_kind(m.subject) == IRI else None

    def object_test(
        term_map: TermMap, of: dict[str, T.DataType], kind: str, datatype: str | None = None, tagged: bool = False
    ) -> str | None:
        if wanted_o is None:
            return "true"
        if isinstance(wanted_o, str):
            return equals(term_map, of, wanted_o) if kind == IRI else None
        if kind != LITERAL or not (tagged or wanted_o.datatype == (datatype or XSD_STRING)):
            return None
        return equals(term_map, of, wanted_o.value)

    types = {f.name: f.dataType for f in df.schema}
    subjects: list[TermMap] = []
    rows: list[_Row] = []
    joined: list[DataFrame] = []
    for m in maps:
        if not available(types, m.subject, m) or (m.graph is not None and not available(types, m.graph, m)):
            continue
        chosen = subject_test(m)
        if chosen is None:
            continue
        graph = None if m.graph is None else f"nullif(trim({m.graph.sql(types)}), '')"
        start, number = len(rows), len(subjects)
        if only is None or RDF_TYPE in only:
            for cls in m.classes:
                test = object_test(Constant(IRI, cls), {}, IRI)
                if test is not None:
                    rows.append(_Row(number, RDF_TYPE, quoted(cls), IRI, None, None, graph, _both(chosen, test)))
        for om in m.objects:
            predicate = _predicate(types, om, m, only)
            if predicate is None:
                continue
            constant_predicate, computed_predicate, wanted = predicate
            if isinstance(om.object, ParentRef):
                parent_types = _parent_types(om.object, df, m, sources)
                test = object_test(om.object.parent.subject, parent_types, subject_kind(om.object.parent.subject))
                if test is not None:
                    joined.append(_parent_quads(df, types, m, om, sources, graph, predicate, chosen, test))
            elif available(types, om.object, m):
                kind = om.object.term_type
                language = _language(types, om) if kind == LITERAL else None
                test = object_test(om.object, types, kind, om.datatype, language is not None)
                if test is None:
                    continue
                value = om.object.sql(types)
                if wanted is not None:
                    value = f"CASE WHEN {wanted} THEN {value} END"
                rows.append(_Row(number, constant_predicate, value, kind, om.datatype, language, graph,
                                 _both(chosen, test), computed_predicate))
        if len(rows) > start:
            subjects.append(m.subject)
    results = [_exploded(df, types, subjects, rows, subject_parts), *joined] if rows else joined
    return reduce(lambda x, y: x.unionByName(y), results) if results else None


def _both(a: str, b: str) -> str:
    """Conjunction of two tests."""
    return " AND ".join(f"({x})" for x in (a, b) if x != "true") or "true"


def _predicate(types, om: ObjectMap, m: TriplesMap, only) -> tuple[str | None, str | None, str | None] | None:
    """The constant predicate or the SQL of a computed one, and its test for being wanted; None if it never is."""
    if isinstance(om.predicate, str):
        return (om.predicate, None, None) if only is None or om.predicate in only else None
    if not available(types, om.predicate, m):
        return None
    text = om.predicate.sql(types)
    if only is None:
        return None, text, f"{text} IS NOT NULL"
    tests = [test for p in sorted(only) if (test := equals(om.predicate, types, p)) is not None]
    return (None, text, " OR ".join(f"({t})" for t in tests)) if tests else None


@dataclass(frozen=True)
class _Row:
    """One triple that every source row gives; the texts are SQL."""

    subject: int
    predicate: str | None
    value: str
    kind: str
    datatype: str | None
    language: str | None
    graph: str | None
    test: str = "true"
    computed_predicate: str | None = None


def _exploded(df: DataFrame, types, subjects: Sequence[TermMap], rows: Sequence[_Row], subject_parts: int | None = None) -> DataFrame:
    """One array of object values per source row; ``posexplode`` makes the triples.

    The subject and whatever else varies by row is computed below the generator,
    once per source row; the constants of a triple are looked up by position.
    """
    tests = []
    if len(subjects) == 1:
        # A null slot gives no subject: tested on the source columns, so that the scan can skip.
        tests = [f"{named(name)} IS NOT NULL" for name in subjects[0].references()]
    wanted = list(dict.fromkeys(r.test for r in rows))
    if "true" not in wanted:
        tests.append(" OR ".join(f"({test})" for test in wanted))
    below = {f"__s{i}": subject.sql(types) for i, subject in enumerate(subjects)}
    for i, r in enumerate(rows):
        texts = (("lang", r.language), ("g", r.graph), ("p", r.computed_predicate))
        below |= {f"__{name}{i}": text for name, text in texts if text is not None}
    source = df.filter(" AND ".join(f"({test})" for test in tests)) if tests else df
    wide = source.selectExpr("*", *(f"{text} AS {name}" for name, text in below.items()))
    if subject_parts is not None:
        wide = wide.repartition(subject_parts, *(f"__s{i}" for i in range(len(subjects))))
    # The array is written inside the generator: over a column, Spark would infer
    # filters on it and evaluate the values twice.
    values = f"posexplode(array({', '.join(r.value for r in rows)})) AS (__i, o)"
    triples = wide.selectExpr(*below, values)

    def computed(name: str) -> str:
        cases = " ".join(f"WHEN {i} THEN __{name}{i}" for i in range(len(rows)) if f"__{name}{i}" in below)
        return f"CASE __i {cases} END" if cases else "cast(null AS string)"

    firsts = {n: next(i for i, r in enumerate(rows) if r.subject == n) for n in range(len(subjects))}
    later = " ".join(f"WHEN __i >= {firsts[n]} THEN __s{n}" for n in range(len(subjects) - 1, 0, -1))
    subject = f"CASE {later} ELSE __s0 END" if later else "__s0"
    lang = computed("lang")
    dt = _lookup([(r.datatype or XSD_STRING) if r.kind == LITERAL else None for r in rows])
    if any(r.language is not None for r in rows):
        dt = f"CASE WHEN {lang} IS NOT NULL THEN {quoted(LANG_STRING)} ELSE {dt} END"
    predicate = _lookup([r.predicate for r in rows])
    if any(r.computed_predicate is not None for r in rows):
        predicate = f"coalesce({computed('p')}, {predicate})"
    present = "o IS NOT NULL"
    if len(subjects) > 1 or not subjects[0].references():
        present += f" AND {subject} IS NOT NULL"
    columns = {
        "s": subject, "s_kind": _lookup([subject_kind(subjects[r.subject]) for r in rows]),
        "p": predicate, "o": "o", "o_kind": _lookup([r.kind for r in rows]),
        "o_dt": dt, "o_lang": lang, "g": computed("g"),
    }
    return triples.filter(present).selectExpr(*(f"{text} AS {name}" for name, text in columns.items()))


def _lookup(values: Sequence[str | None]) -> str:
    """Constant by position; one value for all needs no lookup."""
    texts = ["cast(null AS string)" if v is None else quoted(v) for v in values]
    return texts[0] if len(set(texts)) == 1 else f"get(array({', '.join(texts)}), __i)"


def subject_kind(subject: TermMap) -> str:
    return IRI if subject.term_type == LITERAL else subject.term_type


def available(types, term_map: TermMap, m: TriplesMap) -> bool:
    missing = [c for c in term_map.references() if c not in types]
    if not missing:
        return True
    if m.missing_reference == "skip":
        return False
    raise ValueError(f"source {m.source} has no column {', '.join(missing)}")


def _language(types, om: ObjectMap) -> str | None:
    if om.language is None:
        return None
    return f"lower({om.language.sql(types) if isinstance(om.language, TermMap) else quoted(om.language)})"


def _parent_types(ref: ParentRef, df: DataFrame, m: TriplesMap, sources) -> dict[str, T.DataType]:
    parent = sources.get(ref.parent.source)
    if parent is None and not ref.joins and ref.parent.source == m.source:
        parent = df
    if parent is None:
        raise ValueError(f"no source {ref.parent.source} for the parent map")
    if not ref.joins and ref.parent.source != m.source:
        raise ValueError("a parent in another source needs a join condition")
    return {f.name: f.dataType for f in parent.schema}


def _parent_quads(df, types, m, om, sources, graph, predicate, subject_test, object_test):
    """Child rows joined to parent rows on the conditions; the object is the parent's subject."""
    ref = om.object
    fixed, computed, wanted = predicate
    parent_types = _parent_types(ref, df, m, sources)
    child = df.filter(_both(subject_test, wanted or "true")).selectExpr(
        f"{m.subject.sql(types)} AS s", f"{computed or quoted(fixed)} AS p", f"{graph or 'cast(null AS string)'} AS g",
        *(f"{named(c)} AS __child{i}" for i, (c, _) in enumerate(ref.joins)),
        *([] if ref.joins else [f"{ref.parent.subject.sql(types)} AS o"]))
    if ref.joins:
        parent = sources[ref.parent.source].filter(object_test).selectExpr(
            f"{ref.parent.subject.sql(parent_types)} AS o",
            *(f"{named(c)} AS __parent{i}" for i, (_, c) in enumerate(ref.joins))).filter("o IS NOT NULL")
        on = [F.col(f"__child{i}") == F.col(f"__parent{i}") for i in range(len(ref.joins))]
        pairs = child.filter("s IS NOT NULL").join(parent, on)
    else:
        pairs = child.filter("s IS NOT NULL AND o IS NOT NULL")
    return pairs.selectExpr(
        "s", f"{quoted(subject_kind(m.subject))} AS s_kind", "p", "o",
        f"{quoted(subject_kind(ref.parent.subject))} AS o_kind", "cast(null AS string) AS o_dt",
        "cast(null AS string) AS o_lang", "g")
