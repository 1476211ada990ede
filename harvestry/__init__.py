"""Spark-first engine for building, merging and analysing web-harvest tables."""

__version__ = "0.1.0"
