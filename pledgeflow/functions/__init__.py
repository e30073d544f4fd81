"""Column expressions: text, URLs, dates, numbers, nested data."""
