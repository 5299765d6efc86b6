"""Record linkage and data quality on Spark DataFrames."""
