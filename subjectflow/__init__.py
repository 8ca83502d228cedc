"""Longitudinal subject analytics on PySpark DataFrames."""
