"""Storage-capacity snapshots and reports for database fleets, on Spark DataFrames."""
