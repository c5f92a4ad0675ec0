"""XML values in solutions.

``from_xml`` gives typed values; ``xpath_string`` reads text at a path.  Both
ignore a default namespace, so paths use plain element names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def xml_parse(col: Column, schema: str | StructType) -> Column:
    """XML text as a typed value; null if it is malformed."""
    text = schema if isinstance(schema, str) else schema.simpleString()
    return F.from_xml(col, text, {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"})


def list_schema(path: Sequence[str], fields: Sequence[str]) -> str:
    """Schema of a document in which ``path`` leads to repeated elements with text fields."""
    item = "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"
    schema = f"array<{item}>"
    for name in reversed(path):
        schema = f"struct<`{name}`: {schema}>"
    return schema


def nodes_at(parsed: Column, path: Sequence[str]) -> Column:
    for name in path:
        parsed = parsed.getField(name)
    return parsed


def xml_unnest(sol: DataFrame, col: str, path: Sequence[str], name: str, fields: Sequence[str]) -> DataFrame:
    """One row per element at ``path`` below the root, as a struct of its text fields."""
    parsed = xml_parse(F.col(col), list_schema(path, fields))
    return sol.select("*", F.explode(nodes_at(parsed, path)).alias(name))


def field_text(node: str, field: str) -> Column:
    """Text of a child element of an unnested node; missing or empty is unbound."""
    return F.nullif(F.col(node).getField(field), F.lit(""))


def xml_path(col: Column, path: str) -> Column:
    """Text at an XPath; no match or an empty text is unbound."""
    return F.nullif(F.xpath_string(col, F.lit(path)), F.lit(""))
