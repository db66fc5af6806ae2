"""Operators of a training-data pipeline over documents, conversations and vectors.

Thirteen operators, one module each, with their registered queries in
``queries.py`` and the DuckDB statements in ``sql.py``.  Nothing else in the
library imports this subpackage.
"""
