"""The registered queries, by area.  Importing the package fills the registry."""

from quadspark.plans.catalog import (  # noqa: F401
    files,
    functions,
    graphs,
    logs,
    mapping,
    patterns,
    statistics,
    xml,
)
