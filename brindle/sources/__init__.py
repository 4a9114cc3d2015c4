"""Brindle sources."""
