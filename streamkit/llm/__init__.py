"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface and the thin ``opN_<name>`` query that
applies it to a whole table; ``registry`` lists the queries.
"""
