"""Column expressions: projections and renames, dates as text, text helpers."""
