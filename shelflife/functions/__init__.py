"""Column expressions: fixed values, text, time and scoring rules."""
