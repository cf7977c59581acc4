"""sportlake: team-sport event analytics on Spark DataFrames and Structured Streaming."""
