"""Queries over the record frames, with their SQL twins."""

import recspark.catalog.scans
import recspark.catalog.trees
import recspark.catalog.reports
import recspark.catalog.history
import recspark.catalog.documents
import recspark.catalog.streams  # noqa: F401
from recspark.catalog.base import QUERIES, SQL, cheapest_first

__all__ = ["QUERIES", "SQL", "cheapest_first"]
