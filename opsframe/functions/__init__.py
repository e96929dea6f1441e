"""Column expressions: text, URLs, times, sizes and keys.  No Python UDF."""
