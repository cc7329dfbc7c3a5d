"""Spark-native data jobs: staging, star schemas, keyed tables, checks and streams."""
