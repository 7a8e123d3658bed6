"""Table operators: pure functions from DataFrames and literals to DataFrames."""
