"""Registered queries; importing this package registers all of them."""

from brindle.plans import queries, research_queries  # noqa: F401
