"""Column expressions: text, relative time, scoring. All native, no Python UDF."""
