"""Route mining on Spark DataFrames: features, similarity joins, clustering and reports."""
