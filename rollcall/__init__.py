"""Resolve landed entity names against a dictionary and publish ranked snapshots, on Spark."""
