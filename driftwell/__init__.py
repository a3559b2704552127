"""Device telemetry quality, identity and windowing on Spark DataFrames."""
