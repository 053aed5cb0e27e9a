"""Operators for large training-data pipelines.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries when it can be imported.
"""
