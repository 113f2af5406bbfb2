"""Operators for building training data from a text corpus, and their queries.

Nothing else in the package imports this subpackage; it can be removed as a whole.
"""
