"""Hourly and daily observations as Spark DataFrames: land, load, roll up, reconcile, check."""
