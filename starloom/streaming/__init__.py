"""Structured Streaming entry points: the incremental loaders (SCD2 merge,
incremental dimension load) applied to a feed as it arrives."""
