"""Model evaluation and metric tracking on Spark DataFrames and Spark ML."""
