"""Table operators: DataFrame in, DataFrame out. No action, clock or randomness."""
