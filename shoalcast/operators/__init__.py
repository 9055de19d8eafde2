"""Relational building blocks: joins, windows, reshaping, aggregation, estimators."""
