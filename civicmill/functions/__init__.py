"""Column expressions: casts, text, people, dates and string similarity."""
