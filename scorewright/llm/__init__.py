"""Training-data pipeline operators: one module per operator, queries in ``queries.py``.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries
when the package is there.
"""
