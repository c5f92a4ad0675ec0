"""Joins on any number of possibly unbound variables.

Which variables a row binds is data: its mask.  Two rows can only be partners on
the variables that both bind, so every row is written once for each mask of the
other side that occurs, with a hash of the terms that this pair of masks has in
common, and one equi-join on (masks, hash) finds the partners.  The plan does
not grow with the number of variables; the rows grow with the number of masks
that the other side really has.

The plan knows the size of the stored rows, not that of the rows written for
each mask, so it would broadcast rows that are many times larger than it thinks:
the joins are told to sort and merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.functions.terms import SUFFIXES, columns_of, maybe_unbound
from quadspark.sources.storage import stored_table

_OWN = ("__mask", "__id")


def _masked(df: DataFrame, shared: Sequence[str], name: str) -> tuple[DataFrame, list[str]]:
    """The rows as a table, with their mask and a number, and the masks that occur."""
    bits = [F.when(F.col(v).isNotNull(), "1").otherwise("0") if maybe_unbound(df, v) else F.lit("1") for v in shared]
    plain = df.select(*(F.col(c) for c in df.columns), F.concat(*bits).alias("__mask"), F.monotonically_increasing_id().alias("__id"))
    stored, _ = stored_table(plain, f"masks-{name}")
    # At most two to the number of variables, and one unless something is unbound.
    return stored, sorted(r[0] for r in stored.select("__mask").distinct().collect())


def _same(left: DataFrame, right: DataFrame, v: str) -> Column:
    """Equality of whole terms, or one side unbound; columns of the right side begin with ``__r_``."""
    parts = [F.col(v) == F.col(f"__r_{v}")]
    for suffix in SUFFIXES:
        c = v + suffix
        if c in left.columns and c in right.columns:
            parts.append(F.col(c).eqNullSafe(F.col(f"__r_{c}")))
    same = reduce(lambda a, b: a & b, parts)
    return F.col(v).isNull() | F.col(f"__r_{v}").isNull() | same


def _common(mask: str, other: str) -> bool:
    return any(a == b == "1" for a, b in zip(mask, other, strict=True))


def _keyed(df: DataFrame, shared: Sequence[str], others: Sequence[str], own: Sequence[str], prefix: str) -> DataFrame:
    """Each row once for every mask of the other side that it has a variable in common with."""
    met = F.create_map(*(x for m in own for x in (F.lit(m), F.array(*(F.lit(o) for o in others if _common(m, o))).cast("array<string>"))))
    rows = df.withColumn("__other", F.explode(met[F.col("__mask")]))
    both = [(F.substring("__mask", i + 1, 1) == "1") & (F.substring("__other", i + 1, 1) == "1") for i in range(len(shared))]
    terms = [F.when(b, F.col(v)) for b, v in zip(both, shared, strict=True)]
    rows = rows.withColumn("__key", F.xxhash64(*terms))
    return rows.select(*(F.col(c).alias(prefix + c) for c in rows.columns))


def _partners(left: DataFrame, right: DataFrame, shared: Sequence[str]):
    """Left rows, right rows (columns begin with ``__r_``), the condition of partners, and both sides' masks."""
    l, l_masks = _masked(left, shared, "left")
    r, r_masks = _masked(right, shared, "right")
    if not l_masks or not r_masks:
        l_masks, r_masks = l_masks or ["1" * len(shared)], r_masks or ["1" * len(shared)]
    on = (F.col("__key") == F.col("__r___key")) & (F.col("__mask") == F.col("__r___other")) & (F.col("__other") == F.col("__r___mask"))
    for v in shared:
        on = on & _same(left, right, v)
    return l, l_masks, r, r_masks, _keyed(l, shared, r_masks, l_masks, ""), _keyed(r, shared, l_masks, r_masks, "__r_"), on


def join(left: DataFrame, right: DataFrame, shared: Sequence[str]) -> DataFrame:
    """Compatible pairs that share a bound variable; a shared variable is taken from the side that binds it.

    Raises an error if two rows' masks have nothing in common: any such rows
    would be partners.
    """
    _, l_masks, _, r_masks, l, r, on = _partners(left, right, shared)
    if not all(_common(a, b) for a in l_masks for b in r_masks):
        raise ValueError("solutions may be joined with no bound variable in common; pass allow_product=True if that is meant")
    columns = []
    for v in dict.fromkeys([c for c in left.columns]):
        owner = next((s for s in shared if v in (s, *(s + x for x in SUFFIXES))), None)
        if owner is None:
            columns.append(F.col(v))
    for v in shared:
        mine, theirs = set(columns_of(left, v)), set(columns_of(right, v))
        for c in dict.fromkeys([*columns_of(left, v), *columns_of(right, v)]):
            a = F.col(c) if c in mine else F.lit(None).cast("string")
            b = F.col(f"__r_{c}") if c in theirs else F.lit(None).cast("string")
            columns.append(F.when(F.col(v).isNotNull(), a).otherwise(b).alias(c))
    taken = {c for v in shared for c in columns_of(right, v)}
    columns += [F.col(f"__r_{c}").alias(c) for c in right.columns if c not in taken]
    return l.hint("merge").join(r, on).select(*columns)


def matched(
    left: DataFrame, right: DataFrame, shared: Sequence[str], keep: bool, need_common: bool, cond: Column | None = None
) -> DataFrame:
    """Left rows with (``keep``) or without a compatible row on the right.

    ``need_common``: partners share a bound variable; otherwise rows whose masks
    have nothing in common are partners, too.  ``cond`` may use columns of both.
    """
    rows, l_masks, _, r_masks, l, r, on = _partners(left, right, shared)
    others = [c for c in right.columns if c not in {x for v in shared for x in columns_of(right, v)}]
    # The right side's own variables keep their names, as a condition writes them.
    r = r.select(*(F.col(c) for c in r.columns), *(F.col(f"__r_{c}").alias(c) for c in others)) if cond is not None else r
    found = l.hint("merge").join(r, on if cond is None else on & cond, "left_semi").select("__id").distinct()
    free = [a for a in l_masks if any(not _common(a, b) for b in r_masks)] if not need_common and not right.isEmpty() else []
    if free and cond is not None:
        raise ValueError("a condition needs a variable that is bound on both sides")
    if free:
        found = found.unionByName(rows.filter(F.col("__mask").isin(free)).select("__id")).distinct()
    return rows.hint("merge").join(found, "__id", "left_semi" if keep else "left_anti").select(*left.columns)
