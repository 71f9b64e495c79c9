"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it.  Shared conventions: every operator
accepts nulls in any column (null text counts as empty), empty and very long
texts, ties and repeated rows, empty tables and extra columns (ignored unless
the operator returns its input rows); intermediate tables go to the folder
named by ``spark.checkpoint.dir``.
"""
