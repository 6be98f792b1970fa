"""Batch and streaming data operators and named analytical queries on Spark."""
