"""Operators for large training-data pipelines.

One module per operator; ``queries`` registers one query per operator over
the corpus tables.  Nothing else in the library imports this subpackage.
"""
