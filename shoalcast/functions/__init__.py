"""Column functions: text, calendar, numbers, flags, names."""
