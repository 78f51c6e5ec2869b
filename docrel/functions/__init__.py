"""Column functions: text, numbers, dates, brands and types."""
