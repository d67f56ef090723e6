"""Sales and inventory analytics as plain functions over Spark DataFrames."""
