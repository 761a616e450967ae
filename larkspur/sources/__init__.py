"""Files, tables and SQL text as DataFrames."""
