"""Tidemark: a PySpark-native ingestion and table-commit engine."""

__version__ = "0.1.0"
