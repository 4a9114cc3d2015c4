"""Brindle streaming."""
