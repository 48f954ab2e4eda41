"""Territorial and operational analytics as composable PySpark operators."""

__version__ = "0.1.0"
