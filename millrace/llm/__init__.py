"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this package; ``catalog`` lists its
queries for ``__spark_entry__.py``. The package file stays empty so that
Python workers import only the operator they run.
"""
