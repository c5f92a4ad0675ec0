"""The knowledge graph that the catalogue queries use, mapped from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadspark.functions.terms import XSD_DECIMAL, XSD_INTEGER
from quadspark.operators.mapping import MappedGraph, TriplesMap, expression, pom, template
from quadspark.plans.registry import table
from quadspark.sources.storage import spread_small

EX = "http://example.org/"
MONEY = "decimal(18,2)"


def node(name: str, key: str):
    return template(f"{EX}{name}/{{{key}}}")


def _money(column: str):
    return expression(f"cast({column} AS {MONEY})")


def maps() -> dict[str, TriplesMap]:
    """Triples maps by table; keys identify the rows, but for line items."""
    return {
        "region": TriplesMap("region", node("region", "r_regionkey"), [pom(EX + "name", "r_name")], [EX + "Region"], unique=True),
        "nation": TriplesMap("nation", node("nation", "n_nationkey"), [
            pom(EX + "name", "n_name"), pom(EX + "region", node("region", "n_regionkey"))], [EX + "Nation"], unique=True),
        "customer": TriplesMap("customer", node("customer", "c_custkey"), [
            pom(EX + "name", "c_name"), pom(EX + "segment", "c_mktsegment"),
            pom(EX + "nation", node("nation", "c_nationkey"))], [EX + "Customer"], unique=True),
        "supplier": TriplesMap("supplier", node("supplier", "s_suppkey"), [
            pom(EX + "name", "s_name"), pom(EX + "nation", node("nation", "s_nationkey"))], [EX + "Supplier"], unique=True),
        "part": TriplesMap("part", node("part", "p_partkey"), [
            pom(EX + "brand", "p_brand"), pom(EX + "size", "p_size", XSD_INTEGER)], [EX + "Part"], unique=True),
        "orders": TriplesMap("orders", node("order", "o_orderkey"), [
            pom(EX + "status", "o_orderstatus"), pom(EX + "priority", "o_orderpriority"),
            pom(EX + "total", _money("o_totalprice"), XSD_DECIMAL),
            pom(EX + "customer", node("customer", "o_custkey"))], [EX + "Order"], unique=True),
        "lineitem": TriplesMap(
            "lineitem", template(EX + "lineitem/{l_orderkey}-{l_linenumber}"), [
                pom(EX + "order", node("order", "l_orderkey")), pom(EX + "part", node("part", "l_partkey")),
                pom(EX + "supplier", node("supplier", "l_suppkey")),
                pom(EX + "quantity", expression("cast(l_quantity AS bigint)"), XSD_INTEGER),
                pom(EX + "price", _money("l_extendedprice"), XSD_DECIMAL),
                pom(EX + "flag", "l_returnflag")], [EX + "Lineitem"]),
    }


GRAPH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders")


def graph(spark: SparkSession, sf_dir: str, *tables: str) -> MappedGraph:
    """The graph over some tables, all but ``lineitem`` by default."""
    names = tables or GRAPH_TABLES
    known = maps()
    sources = {n: table(spark, sf_dir, n) for n in names}

    def spread(name: str, df: DataFrame) -> DataFrame:
        return spread_small(df, f"{sf_dir}/{name}.parquet", *known[name].subject.references())

    return MappedGraph(sources, [known[n] for n in names], spread)
