"""Warehouse operators for PySpark: functions from DataFrames to DataFrames."""
