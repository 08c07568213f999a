"""Named queries over the projected tables, and their SQL."""

from splicedf.plans import chain, chimeras, comparison, evaluation, files, functions, loci, models, padding, picking, reports, retention, selection, spatial, tables, text  # noqa: F401
from splicedf.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
