"""The registered queries over the driver's tables, each beside its SQL check."""

from entry_queries import aggregates, effort, entries, grids, scalars, zones  # noqa: F401
from entry_queries.registry import QUERIES, SQL  # noqa: F401
