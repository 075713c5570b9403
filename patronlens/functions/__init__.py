"""Column expressions: labels, bands, keys, dates, web addresses."""
