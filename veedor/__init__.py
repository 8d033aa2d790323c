"""Procurement-risk analytics as PySpark DataFrame operators."""
