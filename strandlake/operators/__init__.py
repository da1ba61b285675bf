"""Operators, one module per kind of data."""
