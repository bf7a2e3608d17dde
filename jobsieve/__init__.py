"""Spark-native processing of job posts: ingest, dedupe, skill extraction, insights."""
