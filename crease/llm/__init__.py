"""Operators of a training-data pipeline and their queries (``crease.llm.queries``).

Nothing else in the library imports this subpackage.  Every operator takes a
DataFrame plus the names of the columns it reads, selects only those columns
(so extra columns, whatever their names, never clash) and states in its
docstring what nulls, empty texts, repeated rows and empty tables give.
"""
