"""Sensor and shop-floor analytics on Spark DataFrames."""
