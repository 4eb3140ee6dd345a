"""Operators: functions of DataFrames and parameters that return a DataFrame."""
