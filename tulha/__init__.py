"""Tulha: agricultural-statistics tables on Spark.

Dirty file scans, nested statistical responses, schema-evolving bronze tables,
typed and deduplicated silver tables, gold aggregates, quality reports and
hourly streams, all as DataFrame operations.
"""
