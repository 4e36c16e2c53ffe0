"""Imports every query module, so that the registry is complete."""

from tidemark.queries import assurance, basics, funds, funnel, lifecycle, loading, relations, revenue, stored, web  # noqa: F401
from tidemark.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
