"""Functional-genomics signal analytics as Spark DataFrame operators.

Conventions shared by every module:

* intervals are 0-based, half-open, in columns ``chrom``, ``s``, ``e``;
* the sample is a column, never a loop;
* an operator maps DataFrames to a DataFrame and runs no action, but for a few that
  write an intermediate they read more than once (``session.stage``).
"""
