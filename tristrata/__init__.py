"""Layered visit analytics expressed as PySpark DataFrame transformations."""
