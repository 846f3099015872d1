"""Operators of a training-data pipeline: ten numbered operators, each by its own method.

Nothing else in the library imports this subpackage; deleting the folder leaves the rest
working. `queries.QUERIES` / `queries.ORACLE` hold the registered queries.
"""
