"""Warehouse plans: dimensions, facts, normalisation, generators, star build,
and the registry of named queries with their SQL oracles."""
