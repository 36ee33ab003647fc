"""Labelled-array analytics on Spark DataFrames."""
