"""Retail order analytics as PySpark DataFrame operators."""
