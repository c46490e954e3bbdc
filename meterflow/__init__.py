"""Energy-metering analytics on Spark DataFrames."""
