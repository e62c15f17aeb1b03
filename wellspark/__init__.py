"""Well-production, sensor-window and well-log analytics on Spark DataFrames."""
