"""Named queries over the given tables, each with SQL that must give the same rows."""

from parcelle.queries import listings, pages  # noqa: F401  (each registers its queries)
from parcelle.queries.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
