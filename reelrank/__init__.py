"""reelrank — rating analytics and recommendations as Spark DataFrame jobs.

Subpackages:
  sources    loaders, the domain views over the driver tables, table I/O
  functions  column-level helpers (built-in Spark expressions only)
  operators  statistics, top-k, similarity, content features, ALS, re-ranking
  streaming  Structured Streaming wrapper around the batch re-ranker
  plans      the named queries and their DuckDB oracles
"""

__version__ = "0.1.0"
