"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this package; ``__spark_entry__.py``
adds its queries only when the package is there.
"""
