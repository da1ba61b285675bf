"""Operators for training-data pipelines, and their registered queries.

Nothing else in the library imports this subpackage.
"""


def load_queries():
    """(name -> query, name -> SQL) of the operators here and of the pipeline."""
    from . import queries

    return queries.QUERIES, queries.ORACLE
