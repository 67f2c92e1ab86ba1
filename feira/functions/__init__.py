"""Column expressions: calendar ages, declared text widths, state names."""
