"""Registered queries over the given tables."""

from docwright.plans import assembly_queries, catalogue_queries, document_queries, repair_queries, report_queries, run_queries  # noqa: F401
from docwright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
