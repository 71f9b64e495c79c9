"""Table-level operators: keys, dedupe, lookups, unions, SCD2, profiling, quality."""
