"""Scoring of contracts as they arrive."""
