"""Registered queries; importing this package fills ``registry.QUERIES``."""

from . import bandit, campaign, evaluation, graph, ingest, published, quality, recs, relational  # noqa: F401
from .registry import QUERIES

__all__ = ["QUERIES"]
