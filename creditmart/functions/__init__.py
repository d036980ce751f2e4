"""Column expressions: cleaning, dates, features."""
