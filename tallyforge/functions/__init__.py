"""Column expressions: parsing, labels, shares and periods."""
