"""Table operators: DataFrames in, one DataFrame out, no actions inside."""
