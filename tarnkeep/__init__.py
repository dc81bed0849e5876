"""Lakehouse data operators written as plain Spark DataFrame transformations."""
