"""Vital-statistics transformation and analytics on Spark DataFrames."""
