"""Training-data operators on Spark DataFrames; see README.md beside this file."""
