"""Registered queries: each runs library operators over the whole driver tables."""

from strata.queries import io, merges, quality, relational, streams, text  # noqa: F401  (registers)
from strata.queries.registry import QUERIES

__all__ = ["QUERIES"]
