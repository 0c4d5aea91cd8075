"""Column functions: text, dates."""
