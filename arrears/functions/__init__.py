"""Column expressions: dates, text, numbers, bands and report formats."""
