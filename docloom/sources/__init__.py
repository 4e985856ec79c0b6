"""Files as DataFrames, and sinks."""
