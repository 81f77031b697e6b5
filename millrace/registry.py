"""The registry of the engine's own queries and their DuckDB SQL."""

from .plans import landing  # noqa: F401  (registers its queries)
from .plans.queries import ORACLES, QUERIES

FLAGSHIP = "operator_registry"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
