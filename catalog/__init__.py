"""Queries on the driver's tables: stand-in inputs, Spark queries and their SQL twins."""
