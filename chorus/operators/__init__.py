"""DataFrame operators: each takes DataFrames and parameters and returns a
lazy DataFrame (no action), except where noted."""
