"""Operators: functions from canonical DataFrames to one DataFrame."""
