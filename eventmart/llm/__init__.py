"""Operators for preparing training data from large text corpora.

Nothing else in the library imports this package. Operators keep a general interface; `queries` holds the
registered queries and their SQL.
"""
