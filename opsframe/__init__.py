"""DataFrame and Structured Streaming operators for running large batch workloads.

Every operator takes DataFrames (or Columns) and returns a DataFrame (or a
Column).  Nothing here builds a session: the caller's session, its shuffle
settings and its ``spark.checkpoint.dir`` are used as they are.
"""
