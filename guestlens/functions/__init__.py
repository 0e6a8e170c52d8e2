"""Column expressions and small helpers for result rows."""
