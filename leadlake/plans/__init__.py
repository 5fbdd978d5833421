"""Registered queries: importing the modules fills the registry."""

from leadlake.plans import enriched, fields, leads, queries, searches, streams, views
from leadlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "enriched", "fields", "leads", "queries", "searches", "streams", "views"]
