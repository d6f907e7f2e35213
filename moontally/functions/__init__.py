"""Column helpers: calendar arithmetic, text parsing, flags and null-safe formulas."""
