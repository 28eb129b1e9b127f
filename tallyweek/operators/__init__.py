"""Table-level operators: DataFrame in, DataFrame out, columns given by name."""
