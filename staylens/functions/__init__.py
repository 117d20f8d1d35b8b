"""Column expressions: parsing, text, numbers, dates, geography, similarity."""
