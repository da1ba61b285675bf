"""Readers: text formats in, DataFrames out."""
