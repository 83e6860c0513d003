"""Operators for preparing language-model training data.

Each module holds one operator (or a helper that several share); ``queries``
binds them to the tables of a data directory.  Nothing else in the library
imports this subpackage.
"""
