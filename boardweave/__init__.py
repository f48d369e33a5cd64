"""Integrate overlapping record feeds into trusted tables, on Spark."""
