"""Graph patterns over mapped tables as joins of the tables.

Every triple pattern is answered by the object maps that can give it.  Patterns
that share a variable join the rows behind them on the source columns, where
both sides build the term with one template; terms become strings only in the
result.  Choices whose terms can never be equal are left out, and patterns about
one subject of a map with unique subjects are answered by one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadspark.functions.terms import IRI, LANG_STRING, LITERAL, RDF_TYPE, XSD_STRING, Literal
from quadspark.operators.inversion import equals, same
from quadspark.operators.mapping import MappedGraph, ObjectMap, ParentRef, TriplesMap, available, subject_kind
from quadspark.operators.termmaps import Constant, Expression, Reference, Template, TermMap, named, quoted

#: More unions than this, of choices that cannot be told apart, are left to the joins of triples.
MAX_CHOICES = 32


@dataclass(frozen=True)
class Use:
    """A term that a row of a scan gives; its map refers to the scan's renamed columns."""

    scan: int
    term_map: TermMap
    kind: str
    datatype: str | None = None
    language: str | None = None  # SQL text

    def dt(self) -> str:
        if self.kind != LITERAL:
            return "cast(null AS string)"
        plain = quoted(self.datatype or XSD_STRING)
        return plain if self.language is None else f"CASE WHEN {self.language} IS NOT NULL THEN {quoted(LANG_STRING)} ELSE {plain} END"


@dataclass(frozen=True)
class Scan:
    """Rows of a source, with its columns renamed; ``computed`` are values of free SQL."""

    source: str
    map: TriplesMap | None
    columns: dict[str, T.DataType]
    computed: dict[str, str] = field(default_factory=dict)


@dataclass
class Choice:
    """One way to answer the patterns seen so far."""

    scans: list[Scan] = field(default_factory=list)
    #: SQL tests with the scans that they concern.
    tests: list[tuple[frozenset[int], str]] = field(default_factory=list)
    bound: dict[str, Use] = field(default_factory=dict)
    #: Scans by (subject variable, place of the map) for maps with unique subjects.
    rows: dict[tuple[str, int], int] = field(default_factory=dict)

    def copy(self) -> Choice:
        return Choice(list(self.scans), list(self.tests), dict(self.bound), dict(self.rows))

    def types(self) -> dict[str, T.DataType]:
        return {renamed(i, c): t for i, scan in enumerate(self.scans) for c, t in scan.columns.items()} | {
            name: T.StringType() for scan in self.scans for name in scan.computed}

    def scan(self, graph: MappedGraph, source: str, m: TriplesMap | None) -> int:
        self.scans.append(Scan(source, m, {f.name: f.dataType for f in graph.sources[source].schema}))
        return len(self.scans) - 1

    def use(self, scan: int, term_map: TermMap, kind: str, datatype: str | None = None, language: str | None = None) -> Use:
        """A term of a scan, which only rows with all its columns give."""
        moved = self._moved(scan, term_map)
        columns = moved.references()
        self.tests += [(frozenset([scan]), f"{named(c)} IS NOT NULL") for c in columns]
        return Use(scan, moved, kind, datatype, language)

    def language(self, scan: int, om: ObjectMap) -> str | None:
        if om.language is None or om.object.term_type != LITERAL:
            return None
        if not isinstance(om.language, TermMap):
            return quoted(om.language.lower())
        return f"lower({self._moved(scan, om.language).sql(self.types())})"

    def _moved(self, scan: int, term_map: TermMap) -> TermMap:
        if isinstance(term_map, Template):
            pattern = term_map.pattern
            for c in set(term_map.references()):
                pattern = pattern.replace("{" + c + "}", "{" + renamed(scan, c) + "}")
            return replace(term_map, pattern=pattern)
        if isinstance(term_map, Reference):
            return replace(term_map, column=renamed(scan, term_map.column))
        if isinstance(term_map, Expression):
            computed = self.scans[scan].computed
            known = [name for name, text in computed.items() if text == term_map.text]
            name = known[0] if known else f"__{scan}x{len(computed)}"
            computed_now = computed | {name: term_map.text}
            self.scans[scan] = replace(self.scans[scan], computed=computed_now)
            return Reference(term_map.term_type, name)
        return term_map

    def equate(self, a: Use, b: Use) -> bool:
        """Demand that two uses are one term; False if they never are."""
        types = self.types()
        if a.kind != b.kind:
            return False
        tests = same(a.term_map, types, b.term_map, types)
        if tests is None:
            return False
        if a.kind == LITERAL:
            if a.language is None and b.language is None:
                if (a.datatype or XSD_STRING) != (b.datatype or XSD_STRING):
                    return False
            else:
                none = "cast(null AS string)"
                tests = [*tests, f"{a.dt()} = {b.dt()}", f"({a.language or none}) <=> ({b.language or none})"]
        where = frozenset({a.scan, b.scan})
        self.tests += [(where, test) for test in tests if test != "true"]
        return True

    def constant(self, use: Use, wanted: str | Literal) -> bool:
        """Demand a constant term."""
        literal = isinstance(wanted, Literal)
        if use.kind != (LITERAL if literal else IRI):
            return False
        tests = [equals(use.term_map, self.types(), wanted.value if literal else wanted)]
        if literal:
            if use.language is None and wanted.datatype != (use.datatype or XSD_STRING):
                return False
            if use.language is not None:
                tag = quoted(wanted.lang.lower()) if wanted.lang else "cast(null AS string)"
                tests += [f"{use.dt()} = {quoted(wanted.datatype)}", f"({use.language}) <=> {tag}"]
        if tests[0] is None:
            return False
        self.tests += [(frozenset([use.scan]), test) for test in tests if test != "true"]
        return True

    def place(self, place, use: Use) -> bool:
        """Bind a variable, or demand what is bound or constant."""
        if not (isinstance(place, str) and place.startswith("?")):
            return self.constant(use, place)
        if place in self.bound:
            return self.equate(self.bound[place], use)
        self.bound[place] = use
        return True


def renamed(scan: int, column: str) -> str:
    return f"__{scan}_{column}"


def _extended(graph: MappedGraph, choice: Choice, pattern: tuple) -> list[Choice]:
    """The ways to answer one more pattern."""
    s, p, o = pattern
    found = []
    for number, m in enumerate(graph.maps):
        types = {f.name: f.dataType for f in graph.sources[m.source].schema}
        if not available(types, m.subject, m):
            continue
        objects: list[ObjectMap | str] = list(m.objects)
        if p == RDF_TYPE:
            objects += list(m.classes)
        for om in objects:
            if isinstance(om, ObjectMap):
                if isinstance(om.predicate, str):
                    if om.predicate != p:
                        continue
                elif not available(types, om.predicate, m):
                    continue
                if not isinstance(om.object, ParentRef) and not available(types, om.object, m):
                    continue
            new = choice.copy()
            at = new.rows.get((s, number)) if m.unique else None
            if at is None:
                at = new.scan(graph, m.source, m)
                if not new.place(s, new.use(at, m.subject, subject_kind(m.subject))):
                    continue
                if m.unique and isinstance(s, str) and s.startswith("?"):
                    new.rows[s, number] = at
            if isinstance(om, ObjectMap) and not isinstance(om.predicate, str):
                if not new.constant(new.use(at, om.predicate, IRI), p):
                    continue
            if new.place(o, _object(graph, new, at, m, om)):
                found.append(new)
    return found


def _object(graph: MappedGraph, choice: Choice, at: int, m: TriplesMap, om: ObjectMap | str) -> Use:
    if isinstance(om, str):
        return choice.use(at, Constant(IRI, om), IRI)
    if not isinstance(om.object, ParentRef):
        return choice.use(at, om.object, om.object.term_type, om.datatype, choice.language(at, om))
    parent = om.object.parent
    if not om.object.joins:
        return choice.use(at, parent.subject, subject_kind(parent.subject))
    other = choice.scan(graph, parent.source, parent)
    choice.tests += [(frozenset([at, other]), f"{named(renamed(at, a))} = {named(renamed(other, b))}") for a, b in om.object.joins]
    return choice.use(other, parent.subject, subject_kind(parent.subject))


def _solution(graph: MappedGraph, choice: Choice, columns: Sequence[tuple[str, bool]]) -> DataFrame | None:
    """The choice as a DataFrame; None if some scans are not connected by an equality."""
    types = choice.types()
    frames = []
    for i, scan in enumerate(choice.scans):
        frame = graph.sources[scan.source].selectExpr(
            *(f"{named(c)} AS {named(renamed(i, c))}" for c in scan.columns),
            *(f"cast({text} AS string) AS {named(name)}" for name, text in scan.computed.items()))
        own = list(dict.fromkeys(test for where, test in choice.tests if where == {i}))
        frames.append(frame.filter(" AND ".join(f"({t})" for t in own)) if own else frame)
    joined, rows = {0}, frames[0]
    across = [(where, test) for where, test in choice.tests if len(where) > 1]
    while len(joined) < len(frames):
        reached = sorted({i for where, _ in across if where & joined for i in where - joined})
        if not reached:
            return None
        new = reached[0]
        on = [test for where, test in across if new in where and where <= joined | {new}]
        rows = rows.join(frames[new], [F.expr(test) for test in dict.fromkeys(on)])
        joined.add(new)
    out = []
    for name, with_type in columns:
        use = choice.bound[name]
        out += [f"{use.term_map.sql(types)} AS {named(name[1:])}", f"{quoted(use.kind)} AS {named(name[1:] + '_kind')}"]
        if with_type:
            out += [f"{use.dt()} AS {named(name[1:] + '_dt')}",
                    f"{use.language or 'cast(null AS string)'} AS {named(name[1:] + '_lang')}"]
    return rows.selectExpr(*out)


def unfold(graph: MappedGraph, patterns: Sequence[tuple]) -> DataFrame | None:
    """Solutions of a connected basic graph pattern over the default graph, in the order given.

    None if the patterns or the mapping ask for something else: a variable
    predicate, maps into named graphs, rows joined by nothing but a constant, or
    too many choices.
    """
    if any(isinstance(p, str) and p.startswith("?") for _, p, _ in patterns) or any(m.graph is not None for m in graph.maps):
        return None
    choices = [Choice()]
    for pattern in patterns:
        choices = [new for choice in choices for new in _extended(graph, choice, pattern)]
        if len(choices) > MAX_CHOICES:
            return None
    if not choices:
        return None
    names = list(dict.fromkeys(x for s, _, o in patterns for x in (s, o) if isinstance(x, str) and x.startswith("?")))
    if not names:
        return None
    columns = [(name, all(s != name for s, _, _ in patterns)) for name in names]
    parts = [_solution(graph, choice, columns) for choice in choices]
    if any(part is None for part in parts):
        return None
    return reduce(lambda a, b: a.unionByName(b), parts)
