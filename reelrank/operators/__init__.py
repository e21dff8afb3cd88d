"""Operators: statistics, top-k, similarity, content features, ALS, stream re-ranking."""
