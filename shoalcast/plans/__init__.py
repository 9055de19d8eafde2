"""Public functions: from raw inputs to clean tables, estimates and totals."""
