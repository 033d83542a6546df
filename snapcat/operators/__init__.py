"""Table operators: DataFrame -> DataFrame."""
