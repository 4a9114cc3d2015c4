"""Brindle operators."""
