"""News activity lined up with market prices, as plain Spark DataFrames and streams."""
