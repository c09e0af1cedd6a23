"""Operators for training-data preparation over documents, vectors and pages.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries.py`` holds the thin registered
queries ``opN_<name>``.
"""
