"""Graph patterns and the solution algebra.

A pattern place is a variable (``"?x"``), an IRI string or a ``Literal``.
Solutions are bags: nothing here removes repeated rows unless it says so.

Joins compare whole terms.  A variable that an earlier operator left possibly
unbound carries a mark (``mark_unbound``); only for such variables are the
inputs split by boundness, and every part is then an equi-join again.  No
operator falls back to a nested-loop comparison.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.functions.scalars import decimal, double
from quadspark.functions.terms import (
    BNODE,
    IRI,
    LITERAL,
    QUAD_COLUMNS,
    SUFFIXES,
    TRIPLE_COLUMNS,
    Literal,
    Term,
    as_quads,
    columns_of,
    constant,
    iri_term,
    mark_unbound,
    maybe_unbound,
    null,
    term,
    term_key,
    variables,
)
from quadspark.operators import masks
from quadspark.operators.inversion import keys_of
from quadspark.operators.mapping import apply_mapping
from quadspark.operators.unfold import unfold

DEFAULT_GRAPH = object()
ANY_GRAPH = object()

# A split by boundness gives up to 3^n parts of a plan; with more variables than
# this, masks are data (``masks``).
MAX_UNBOUND_KEYS = 2


def is_var(place) -> bool:
    return isinstance(place, str) and place.startswith("?")


# --- Q1, X13: triple patterns -------------------------------------------------

def match(graph, s, p, o, g=DEFAULT_GRAPH) -> DataFrame:
    """Solutions of one triple pattern.

    ``graph`` is a triple or quad DataFrame, or a ``MappedGraph``.  ``g`` is the
    default graph unless it names a graph, is a variable (named graphs only) or
    ``ANY_GRAPH`` (the union of all graphs, as a set of triples).
    """
    if hasattr(graph, "quads"):
        # Constants become tests of the source columns; the exact test follows.
        graph = graph.quads(None if is_var(p) else {p}, None if is_var(s) else s, None if is_var(o) else o)
    quads = _select_graph(graph, g)
    condition = F.lit(True)
    for name, place in (("s", s), ("p", p), ("o", o)):
        if not is_var(place):
            condition = condition & _is_constant(name, place)
    if not is_var(p) and "p_key" in quads.columns:
        condition = condition & (F.col("p_key") == predicate_key(F.lit(p)))
    bindings: dict[str, list[tuple[str, Column]]] = {}
    places = [("s", s), ("p", p), ("o", o)] + ([("g", g)] if is_var(g) else [])
    for name, place in places:
        if is_var(place):
            bindings.setdefault(place[1:], []).append((name, _kind(name)))
    columns: list[Column] = []
    for var, uses in bindings.items():
        if var.endswith(SUFFIXES):
            raise ValueError(f"a variable may not end in {SUFFIXES}: {var}")
        first, kind = uses[0]
        for other, other_kind in uses[1:]:
            condition = condition & (F.col(first) == F.col(other)) & (kind == other_kind)
        columns += [F.col(first).alias(var), kind.alias(var + "_kind")]
        if all(name == "o" for name, _ in uses):
            columns += [F.col("o_dt").alias(var + "_dt"), F.col("o_lang").alias(var + "_lang")]
    return quads.filter(condition).select(*columns)


def predicate_key(p: Column) -> Column:
    """Short, file-name-safe key of a predicate, used to partition stored quads."""
    return F.substring(F.sha2(p, 256), 1, 16)


def _kind(place: str) -> Column:
    return F.lit(IRI) if place in ("p", "g") else F.col(f"{place}_kind")


def _select_graph(quads: DataFrame, g) -> DataFrame:
    has_graph = "g" in quads.columns
    if g is ANY_GRAPH:
        return quads.dropDuplicates(TRIPLE_COLUMNS) if has_graph else quads
    if g is DEFAULT_GRAPH:
        return quads.filter(F.col("g").isNull()) if has_graph else quads
    if not has_graph:
        quads = quads.withColumn("g", null())
    return quads.filter(F.col("g").isNotNull() if is_var(g) else F.col("g") == g)


def _is_constant(name: str, place) -> Column:
    if name == "p":
        return F.col("p") == place
    if isinstance(place, Literal):
        same = (F.col(name) == place.value) & (F.col(f"{name}_kind") == LITERAL)
        same = same & (F.col(f"{name}_dt") == place.datatype)
        return same & F.col(f"{name}_lang").eqNullSafe(F.lit(place.lang.lower() if place.lang else None))
    return (F.col(name) == place) & (F.col(f"{name}_kind") == IRI)


# --- joins --------------------------------------------------------------------

def _shared(left: DataFrame, right: DataFrame) -> list[str]:
    names = set(variables(right))
    return [v for v in variables(left) if v in names]


def _loose(left: DataFrame, right: DataFrame, shared: Iterable[str]) -> list[str]:
    return [v for v in shared if maybe_unbound(left, v) or maybe_unbound(right, v)]


def _renamed(right: DataFrame, shared: Sequence[str]) -> DataFrame:
    taken = {c for v in shared for c in columns_of(right, v)}
    return right.select(*(F.col(c).alias(f"__r_{c}") if c in taken else F.col(c) for c in right.columns))


def _same_terms(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of whole terms between ``left`` and a ``_renamed`` right side."""
    parts = []
    for v in keys:
        lcols, rcols = set(columns_of(left, v)), set(columns_of(right, v))
        parts.append(F.col(v) == F.col(f"__r_{v}"))
        # A side without a datatype column holds no literals, so equal kinds
        # are enough; a plain value column (an aggregate) has no companions.
        if v + "_kind" in lcols and v + "_kind" in rcols:
            parts.append(F.col(v + "_kind") == F.col(f"__r_{v}_kind"))
        for suffix in ("_dt", "_lang"):
            if v + suffix in lcols and v + suffix in rcols:
                parts.append(F.col(v + suffix).eqNullSafe(F.col(f"__r_{v}{suffix}")))
    return reduce(lambda a, b: a & b, parts)


def _bound_is(df: DataFrame, flags: dict[str, bool], prefix: str = "") -> DataFrame:
    for v, is_bound in flags.items():
        if maybe_unbound(df, prefix + v):
            value = F.col(prefix + v)
            df = df.filter(value.isNotNull() if is_bound else value.isNull())
    return df


def _masks(df: DataFrame, loose: Sequence[str]) -> list[dict[str, bool]]:
    """Every combination of bound and unbound that this side can have."""
    choices = [[True, False] if maybe_unbound(df, v) else [True] for v in loose]
    return [dict(zip(loose, c, strict=True)) for c in itertools.product(*choices)]


def join(left: DataFrame, right: DataFrame, allow_product: bool = False) -> DataFrame:
    """Compatible pairs of solutions (inner join on the shared variables)."""
    shared = _shared(left, right)
    if not shared:
        if not allow_product:
            raise ValueError("the two sides share no variable; pass allow_product=True if that is meant")
        return left.join(right)
    loose = _loose(left, right, shared)
    if len(loose) > MAX_UNBOUND_KEYS and not allow_product:
        result = masks.join(left, right, shared)
    else:
        parts = []
        for lmask in _masks(left, loose):
            for rmask in _masks(right, loose):
                part = _join_part(left, right, shared, lmask, rmask, allow_product)
                parts.append(part)
        result = reduce(lambda a, b: a.unionByName(b), parts)
    still = [v for v in loose if maybe_unbound(left, v) and maybe_unbound(right, v)]
    return _restore_marks(result, left, right, still)


def _join_part(left, right, shared, lmask, rmask, allow_product, how="inner", cond=None):
    keys = [v for v in shared if lmask.get(v, True) and rmask.get(v, True)]
    l = _bound_is(left, lmask)
    r = _renamed(_bound_is(right, rmask), shared)
    on = None
    if keys:
        on = _same_terms(left, right, keys)
    elif not allow_product:
        raise ValueError(
            "solutions may be joined with no bound variable in common; "
            "pass allow_product=True if that is meant"
        )
    pairs = l.join(r, on, how)
    columns = []
    for v in variables(left):
        if v not in shared:
            columns += [F.col(c) for c in columns_of(left, v)]
        else:
            columns += _merged(left, right, v, lmask.get(v, True))
    for v in variables(right):
        if v not in shared:
            columns += [F.col(c) for c in columns_of(right, v)]
    return pairs.select(*columns)


def _merged(left, right, v, take_left):
    """Columns of a shared variable, of the side that binds it."""
    lcols, rcols = columns_of(left, v), columns_of(right, v)
    if take_left:
        names = lcols
        if not (maybe_unbound(left, v) or maybe_unbound(right, v)):
            return [F.col(c) for c in names]
        return [F.col(c) if c in lcols else null().alias(c) for c in dict.fromkeys(lcols + rcols)]
    return [
        F.col(f"__r_{c}").alias(c) if c in rcols else null().alias(c)
        for c in dict.fromkeys(lcols + rcols)
    ]


def _restore_marks(result, left, right, still):
    shared = set(_shared(left, right))
    marked = set(still)
    for side in (left, right):
        marked |= {v for v in variables(side) if v not in shared and maybe_unbound(side, v)}
    columns = []
    for c in result.columns:
        metadata = {"unbound": True} if c in marked else {}
        columns.append(F.col(c).alias(c, metadata=metadata))
    return result.select(*columns)


def bgp(graph, patterns: Sequence[tuple], counts: dict[str, int] | None = None, g=DEFAULT_GRAPH) -> DataFrame:
    """Basic graph pattern: the join of its triple patterns.

    Patterns are joined along shared variables, the most selective first:
    constants before variables, then by ``counts`` (triples per predicate, from
    ``property_partition``).  Over mapped tables, their rows are joined on the
    source columns (``unfold``).  Physical strategy and skew splitting are left
    to adaptive execution.
    """
    if not patterns:
        raise ValueError("a basic graph pattern has at least one triple pattern")
    remaining = [(number, tuple(p)) for number, p in enumerate(patterns)]

    def cost(item):
        number, (s, p, o) = item
        free = is_var(s) + is_var(o) + 2 * is_var(p)
        size = (counts or {}).get(p, 0) if not is_var(p) else float("inf")
        return (free, size, number)

    def names(pattern):
        return {x for x in pattern if is_var(x)} | ({g} if is_var(g) else set())

    ordered = [min(remaining, key=cost)]
    seen = names(ordered[0][1])
    while len(ordered) < len(remaining):
        connected = [item for item in remaining if item not in ordered and names(item[1]) & seen]
        if not connected:
            raise ValueError("the pattern is disconnected: it would be a cross product")
        ordered.append(min(connected, key=cost))
        seen |= names(ordered[-1][1])
    triples = [pattern for _, pattern in ordered]
    if hasattr(graph, "maps") and g is DEFAULT_GRAPH:
        solution = unfold(graph, triples)
        if solution is not None:
            return solution
    return reduce(join, (match(graph, *pattern, g=g) for pattern in triples))


def star(graph, subject: str, properties: dict[str, str], optional: Iterable[str] = (), g=DEFAULT_GRAPH) -> DataFrame:
    """Single-valued properties of one subject variable, in one aggregation.

    ``properties`` maps predicate to variable.  It replaces n - 1 self-joins on
    the subject by one shuffle with map-side combine.  A property that has two
    values for a subject fails the query; use ``bgp`` for those.
    """
    if hasattr(graph, "quads"):
        graph = graph.quads(set(properties))
    quads = _select_graph(graph, g).filter(F.col("p").isin(list(properties)))
    optional = set(optional)
    parts = ("o", "o_kind", "o_dt", "o_lang")
    value = F.struct(*parts)
    aggregates = []
    for p, var in properties.items():
        chosen = F.when(F.col("p") == p, value)
        aggregates.append(F.min(chosen).alias(f"__min_{var}"))
        aggregates.append(F.max(chosen).alias(f"__max_{var}"))
    rows = quads.groupBy("s", "s_kind").agg(*aggregates)
    columns = [F.col("s").alias(subject), F.col("s_kind").alias(subject + "_kind")]
    for p, var in properties.items():
        single = F.when(
            F.col(f"__min_{var}").eqNullSafe(F.col(f"__max_{var}")), F.col(f"__min_{var}")
        ).otherwise(F.raise_error(F.lit(f"{p} has more than one value for a subject")))
        columns += [
            single.getField(part).alias(var + suffix)
            for part, suffix in zip(parts, ("", *SUFFIXES), strict=True)
        ]
        if var not in optional:
            rows = rows.filter(F.col(f"__min_{var}").isNotNull())
    return mark_unbound(rows.select(*columns), optional)


# --- X2: optional ---------------------------------------------------------------

def optional(left: DataFrame, right: DataFrame, cond: Column | None = None) -> DataFrame:
    """Left join; ``cond`` may use the variables of both sides and belongs to the join."""
    shared = _shared(left, right)
    if not shared:
        raise ValueError("the optional part shares no variable with the required part")
    loose = _loose(left, right, shared)
    fresh = [v for v in variables(right) if v not in shared]
    if not loose:
        on = _same_terms(left, right, shared)
        if cond is not None:
            on = on & cond
        pairs = left.join(_renamed(right, shared), on, "left")
        keep = [F.col(c) for c in left.columns]
        keep += [F.col(c) for v in fresh for c in columns_of(right, v)]
        return mark_unbound(pairs.select(*keep), fresh)
    matched = join(left, right)
    if cond is not None:
        matched = matched.filter(cond)
    unmatched = _without(left, right, shared, loose, need_common=False, cond=cond)
    return mark_unbound(
        matched.unionByName(unmatched, allowMissingColumns=True),
        [*fresh, *(v for v in loose if maybe_unbound(left, v)),
         *(v for v in variables(left) if v not in shared and maybe_unbound(left, v))],
    )


# --- X3, X4: minus and existence --------------------------------------------------

def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Remove solutions compatible with one on the right that share a bound variable."""
    shared = _shared(left, right)
    if not shared:
        return left
    loose = _loose(left, right, shared)
    if not loose:
        return left.join(_renamed(_keys(right, shared), shared), _same_terms(left, right, shared), "left_anti")
    return _without(left, right, shared, loose, need_common=True)


def not_exists(left: DataFrame, right: DataFrame, cond: Column | None = None) -> DataFrame:
    return _existence(left, right, cond, "left_anti")


def exists(left: DataFrame, right: DataFrame, cond: Column | None = None) -> DataFrame:
    return _existence(left, right, cond, "left_semi")


def _existence(left, right, cond, how):
    shared = _shared(left, right)
    if not shared:
        raise ValueError("the tested pattern shares no variable with the solution")
    loose = _loose(left, right, shared)
    if not loose:
        on = _same_terms(left, right, shared)
        narrow = right if cond is not None else _keys(right, shared)
        return left.join(_renamed(narrow, shared), on if cond is None else on & cond, how)
    if how == "left_anti":
        return _without(left, right, shared, loose, need_common=False, cond=cond)
    if len(loose) > MAX_UNBOUND_KEYS:
        return _marks_of(left, masks.matched(left, right, shared, True, False, cond))
    parts = []
    for lmask in _masks(left, loose):
        part = _bound_is(left, lmask)
        # Each row goes to the first kind of partner that it has.
        for rmask in _masks(right, loose):
            parts.append(_semi_part(part, left, right, shared, lmask, rmask, cond, "left_semi"))
            part = _semi_part(part, left, right, shared, lmask, rmask, cond, "left_anti")
    return reduce(lambda a, b: a.unionByName(b), parts)


def _marks_of(left: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the left side, which a table has taken the marks from."""
    return mark_unbound(rows, [v for v in variables(left) if maybe_unbound(left, v)])


def _without(left, right, shared, loose, need_common, cond=None):
    if len(loose) > MAX_UNBOUND_KEYS:
        return _marks_of(left, masks.matched(left, right, shared, False, need_common, cond))
    parts = []
    for lmask in _masks(left, loose):
        part = _bound_is(left, lmask)
        for rmask in _masks(right, loose):
            common = [v for v in shared if lmask.get(v, True) and rmask.get(v, True)]
            if not common and need_common:
                continue
            part = _semi_part(part, left, right, shared, lmask, rmask, cond, "left_anti")
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b), parts)


def _semi_part(part, left, right, shared, lmask, rmask, cond, how):
    common = [v for v in shared if lmask.get(v, True) and rmask.get(v, True)]
    r = _bound_is(right, rmask)
    if not common:
        # Compatible with every partner: one row on the right decides.
        one = r.limit(1).select(F.lit(1).alias("__one"))
        if cond is not None:
            raise ValueError("a condition needs a variable that is bound on both sides")
        flagged = part.withColumn("__key", F.lit(1))
        return flagged.join(F.broadcast(one), F.col("__key") == F.col("__one"), how).drop("__key")
    narrow = r if cond is not None else _keys(r, shared)
    on = _same_terms(left, right, common)
    return part.join(_renamed(narrow, shared), on if cond is None else on & cond, how)


def _keys(right: DataFrame, shared: Sequence[str]) -> DataFrame:
    return right.select(*(c for v in shared for c in columns_of(right, v)))


# --- simple solution operators ------------------------------------------------------

def project(sol: DataFrame, *names: str, terms: bool = True) -> DataFrame:
    """Named variables, all of them by default; ``terms=False`` keeps lexical values only."""
    chosen = names or variables(sol)
    if not terms:
        return sol.select(*chosen)
    return sol.select(*(c for v in chosen for c in columns_of(sol, v)))


def bind(sol: DataFrame, name: str, value: Term) -> DataFrame:
    """A computed variable; an expression error leaves it unbound."""
    if name in variables(sol):
        raise ValueError(f"variable {name} is already bound")
    return mark_unbound(sol.select("*", *value.columns(name)), [name])


def filter_(sol: DataFrame, cond: Column) -> DataFrame:
    return sol.filter(cond)


def union(*sols: DataFrame) -> DataFrame:
    """Bag union; a variable missing on one side is unbound there."""
    everywhere = set.intersection(*(set(variables(s)) for s in sols))
    names = list(dict.fromkeys(v for s in sols for v in variables(s)))
    loose = [v for v in names if v not in everywhere or any(
        v in variables(s) and maybe_unbound(s, v) for s in sols)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sols)
    return mark_unbound(merged, loose)


def values(spark, names: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """Inline table of constants; ``None`` is unbound.  Its size is that of the query text."""
    schema, flat = [], []
    for v in names:
        schema += [f"{c} string" for c in (v, *(v + suffix for suffix in SUFFIXES))]
    for row in rows:
        cells: list[str | None] = []
        for cell in row:
            if cell is None:
                cells += [None] * 4
            elif isinstance(cell, Literal):
                cells += [cell.value, LITERAL, cell.datatype, cell.lang.lower() if cell.lang else None]
            else:
                cells += [cell, IRI, None, None]
        flat.append(tuple(cells))
    table = spark.createDataFrame(flat, ", ".join(schema))
    loose = [v for i, v in enumerate(names) if any(row[i] is None for row in rows)]
    return mark_unbound(table, loose)


def distinct(sol: DataFrame) -> DataFrame:
    return sol.dropDuplicates()


reduced = distinct


def count_all(sol: DataFrame, name: str = "count") -> DataFrame:
    return sol.agg(F.count(F.lit(1)).alias(name))


def ask(sol: DataFrame) -> DataFrame:
    """One row, ``true`` if there is a solution; stops at the first one."""
    return sol.limit(1).agg((F.count(F.lit(1)) > 0).alias("ask"))


def lateral(sol: DataFrame, branches: Sequence[dict[str, Term]], guard: str | None = None) -> DataFrame:
    """Correlated union of branches that only bind variables.

    Each branch maps variable to term; the branches of a row come from one
    ``inline``.  ``guard`` names a variable that must be bound to keep a row.
    """
    names = list(dict.fromkeys(v for branch in branches for v in branch))
    unbound = Term(null(), null(), null(), null())
    rows = F.array(*(
        F.struct(*(c for v in names for c in branch.get(v, unbound).columns(v))) for branch in branches
    ))
    result = mark_unbound(sol.select("*", F.inline(rows)), names)
    return result.filter(F.col(guard).isNotNull()) if guard else result


def lateral_join(sol: DataFrame, subquery: DataFrame, condition: Column | None = None, how: str = "inner") -> DataFrame:
    """General correlated sub-pattern.

    ``subquery`` refers to ``sol`` by ``Column.outer()``; aggregate in it with
    ``select``, since ``agg`` is resolved before the outer side is known.
    """
    return sol.lateralJoin(subquery, condition, how)


# --- construct ---------------------------------------------------------------------

def construct(sol: DataFrame, template: Sequence[tuple]) -> DataFrame:
    """Quads from solutions, as a set.

    A template place is a variable, a constant or a ``Term``.  Rows with an
    unbound or illegal term are skipped, one template triple at a time.
    """
    structs = []
    for quad in template:
        s, p, o = (_place(sol, x) for x in quad[:3])
        g = _place(sol, quad[3]) if len(quad) > 3 else iri_term(null())
        legal = s.kind.isin(IRI, BNODE) & (p.kind == IRI) & o.value.isNotNull() & s.value.isNotNull()
        structs.append(F.struct(
            F.when(legal, s.value).alias("s"), s.kind.alias("s_kind"), p.value.alias("p"),
            o.value.alias("o"), o.kind.alias("o_kind"), o.dt.alias("o_dt"), o.lang.alias("o_lang"),
            g.value.alias("g"),
        ))
    quads = sol.select(F.inline(F.array(*structs))).filter(F.col("s").isNotNull() & F.col("p").isNotNull())
    return quads.select(*QUAD_COLUMNS).dropDuplicates()


def _place(sol: DataFrame, place) -> Term:
    if isinstance(place, Term):
        return place
    return term(sol, place[1:]) if is_var(place) else constant(place)


def describe(graph, resources: str | DataFrame) -> DataFrame:
    """Quads about one IRI, or about the IRIs in column ``s`` of a DataFrame."""
    if isinstance(resources, str):
        quads = as_quads(graph.quads(s=resources) if hasattr(graph, "quads") else graph)
        return quads.filter((F.col("s") == resources) & (F.col("s_kind") == IRI))
    wanted = resources.select("s").dropDuplicates()
    if hasattr(graph, "maps"):
        parts = [_described(graph, m, wanted) for m in graph.maps]
        return reduce(lambda a, b: a.unionByName(b), parts)
    return _about(as_quads(graph), wanted)


def _about(quads: DataFrame, wanted: DataFrame) -> DataFrame:
    iris = quads.filter(F.col("s_kind") == IRI)
    return iris.join(wanted.select(F.col("s").alias("__s")), F.col("s") == F.col("__s"), "left_semi")


def _described(graph, m, wanted: DataFrame) -> DataFrame:
    """Quads of one map about the IRIs: they are turned into keys, which choose the rows of the source."""
    source = graph.sources[m.source]
    found = keys_of(wanted, m.subject, {f.name: f.dataType for f in source.schema})
    if found is None:
        return _about(as_quads(apply_mapping(source, m, graph.sources)), wanted)
    keys, names = found
    rows = source.join(keys, [source[n] == keys[f"__k{i}"] for i, n in enumerate(names)], "left_semi")
    return as_quads(apply_mapping(rows, m, graph.sources))


# --- order and groups ----------------------------------------------------------------

def order_by(
    sol: DataFrame, *keys: str | tuple[str, str], limit: int | None = None, offset: int = 0
) -> DataFrame:
    """Sort by terms: unbound, blank, IRI, literal; numbers by value.

    With a limit Spark keeps the best rows per task and sorts only those.
    """
    columns: list[Column] = []
    for key in keys:
        name, direction = key if isinstance(key, tuple) else (key, "asc")
        for c in _order_columns(sol, name):
            columns.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_first())
    result = sol.orderBy(*columns)
    if offset:
        result = result.offset(offset)
    return result if limit is None else result.limit(limit)


def _order_columns(sol: DataFrame, name: str) -> list[Column]:
    if f"{name}_kind" not in sol.columns:
        return [F.col(name)]
    kind = F.col(f"{name}_kind")
    rank = F.when(kind == BNODE, 1).when(kind == IRI, 2).when(kind == LITERAL, 3).otherwise(0)
    if f"{name}_dt" not in sol.columns:
        return [rank, F.col(name)]
    t = term(sol, name)
    # DOUBLE covers every number; DECIMAL separates those it rounds together.
    return [rank, double(t), decimal(t), F.col(name)]


def group(
    sol: DataFrame, by: Sequence[str], aggregates: dict[str, Column], having: Column | None = None
) -> DataFrame:
    """Group by whole terms; aggregate results are plain typed columns.

    Spark combines map-side before the shuffle, and splits a distinct count
    into two levels, so a hot group does not meet in one task before it shrank.
    """
    keys = [c for v in by for c in columns_of(sol, v)]
    grouped = sol.groupBy(*keys) if keys else sol.groupBy()
    result = grouped.agg(*(c.alias(name) for name, c in aggregates.items()))
    return result if having is None else result.filter(having)


def count_of(sol: DataFrame, name: str, distinct: bool = False) -> Column:
    if not distinct:
        return F.count(F.col(name))
    present = {c[len(name):] for c in columns_of(sol, name)}
    return F.count_distinct(F.when(F.col(name).isNotNull(), term_key(name, present)))


def sum_of(value: Column, distinct: bool = False) -> Column:
    return F.sum_distinct(value) if distinct else F.sum(value)


def avg_of(value: Column, distinct: bool = False) -> Column:
    return F.sum_distinct(value) / F.count_distinct(value) if distinct else F.avg(value)


def min_of(value: Column) -> Column:
    return F.min(value)


def max_of(value: Column) -> Column:
    return F.max(value)


def sample(name: str) -> Column:
    return F.any_value(F.col(name), True)


def group_concat(name: str, separator: str = " ", distinct: bool = False) -> Column:
    """Joined lexical forms, sorted so that the result is repeatable.

    The string of a group is the result itself and lives in one row; group only
    by keys whose strings may be that long.
    """
    values_ = F.collect_set(name) if distinct else F.collect_list(name)
    return F.array_join(F.sort_array(values_), separator)


__all__ = [
    "ANY_GRAPH", "DEFAULT_GRAPH", "ask", "avg_of", "bgp", "bind", "construct", "count_all",
    "count_of", "describe", "distinct", "exists", "filter_", "group", "group_concat", "is_var", "join",
    "lateral", "lateral_join", "match", "max_of", "min_of", "minus", "not_exists", "optional", "order_by",
    "predicate_key", "project", "reduced", "sample", "star", "sum_of", "union", "values",
]
