"""Retail lakehouse analytics as PySpark DataFrame operators."""
