"""The collection loop as Structured Streaming queries."""
