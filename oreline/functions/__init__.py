"""Column expressions: text, numbers, dates, hashes."""
