"""Column functions: parsing, time arithmetic, numbers, text."""
