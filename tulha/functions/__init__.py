"""Column expressions: names, values, periods and HTML text."""
