"""Spark jobs that turn a company register's raw files into one published, query-ready table."""
