"""Demand analytics over trip and event records, written on Spark DataFrames."""
