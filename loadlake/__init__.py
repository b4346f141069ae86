"""Hourly and sub-hourly load forecasting on Spark DataFrames.

Every operator is a function from DataFrames to DataFrames; ``series_id`` is
part of every key and clock values are always arguments.
"""
