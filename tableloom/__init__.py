"""Table preparation, quality profiling and provenance as plain Spark DataFrames."""
