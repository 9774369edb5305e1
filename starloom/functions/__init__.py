"""Column expressions: text, numbers, dates and label lookups."""
