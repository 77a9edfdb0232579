"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each operator is a
function of DataFrames with its own general interface; ``queries.py`` holds
the thin registered queries, ``oracle.py`` their SQL where SQL can express
them.
"""
