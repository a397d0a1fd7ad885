"""Weather analytics on Spark DataFrames: every function takes and returns DataFrames or Columns."""
