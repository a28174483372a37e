"""Controlled ledger batch loads as plain PySpark DataFrame operators."""

__all__ = ["functions", "operators", "plans", "sources"]
