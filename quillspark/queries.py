"""All queries of the library but those of the training-data subpackage."""

from quillspark.plans import catalog_functions, catalog_jobs, catalog_tables  # noqa: F401  (they register themselves)
from quillspark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
