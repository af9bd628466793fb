"""Queries over the evidence tables and what they register."""

from . import analytics, boards, bulletins, claim_tables, live, matching, pages, relational, texts, varied
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analytics", "boards", "bulletins", "claim_tables", "live", "matching", "pages", "relational", "texts", "varied"]
