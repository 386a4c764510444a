"""Column expressions: time, text measures, references."""
