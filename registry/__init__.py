from registry import more, runs  # noqa: F401  register their queries
from registry.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
