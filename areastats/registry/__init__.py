"""Named queries over the test tables, with the SQL that checks each."""

from areastats.registry import spatial, tabular  # noqa: F401
from areastats.registry.base import CHECKS, QUERIES  # noqa: F401
