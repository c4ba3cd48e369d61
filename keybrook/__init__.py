"""Keyed record streams and the tables derived from them, on Spark."""
