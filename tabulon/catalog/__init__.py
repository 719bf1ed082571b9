"""Named queries over the given tables, each with an SQL statement of the same result where one exists."""
from tabulon.catalog.base import ENTRIES
from tabulon.catalog import (tables, statistics, distances, selections, learners)  # noqa: F401  (fill ENTRIES)

__all__ = ["ENTRIES"]
