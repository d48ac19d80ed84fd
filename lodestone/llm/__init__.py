"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``queries.py`` binds the operators to the synthetic
tables and their result contracts.
"""
