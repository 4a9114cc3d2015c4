"""Brindle: a PySpark-native library for event-history, catalog-audit and training-data work."""
