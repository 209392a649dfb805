"""Retail decisioning operators expressed as PySpark DataFrame transformations."""
