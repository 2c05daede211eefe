"""Column expressions: numbers, dates and text."""
