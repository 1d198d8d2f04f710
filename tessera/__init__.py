"""Catalog building and upkeep for records from many sources, on Spark DataFrames."""
