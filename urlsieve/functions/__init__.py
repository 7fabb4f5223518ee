"""Column expressions: parsing, text measures and the 42 address features."""
