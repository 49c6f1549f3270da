"""Registered queries, each with the SQL that gives the same rows on another engine."""

from tallymark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
