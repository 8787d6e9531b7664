"""Operators for training-data pipelines, their registered queries and SQL twins.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only when it can be imported.
"""
