"""Operators for preparing language-model training data.

Nothing else in the library imports this package; the registered queries are
in ``queries.py`` and their SQL in ``sql.py``.
"""
