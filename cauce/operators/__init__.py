"""Table operators: DataFrames in, DataFrames out, no I/O."""
