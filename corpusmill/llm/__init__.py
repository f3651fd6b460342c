"""Operators of a large-scale training-data pipeline, one module each.

Nothing else in the library imports this subpackage; ``registry`` holds the
queries and their SQL for ``__spark_entry__.py``.
"""
