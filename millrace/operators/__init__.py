"""Table operators: DataFrame in, DataFrame out (fitted scalars where a value is learned)."""
