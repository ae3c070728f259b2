"""Operators for preparing large text corpora.

Nothing else in the library imports this package.  Every module holds one
operator with its general interface; ``registry`` binds the operators to the
tables of the test data.
"""
