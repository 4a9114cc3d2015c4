"""Brindle functions."""
