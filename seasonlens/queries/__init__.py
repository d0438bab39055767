from seasonlens.queries import aggregates, columns, composites, joins, models, sources, views, windows  # noqa: F401
from seasonlens.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
