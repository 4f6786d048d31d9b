"""Inputs derived from the test tables, the registered queries, and their SQL oracles."""

from . import cases_fields, cases_logs, cases_pipelines, cases_tables
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cases_fields", "cases_logs", "cases_pipelines", "cases_tables"]
