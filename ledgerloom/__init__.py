"""Retail analytics as Spark jobs: raw CSV to star schema, marts, 3NF store, checks and reports."""
