"""Station-climate analytics and data preparation as Spark jobs: functions from DataFrames to DataFrames."""
