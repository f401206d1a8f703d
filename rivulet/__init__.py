"""Geometric and document data processing on Spark."""
