"""Operators of a training-data pipeline over large document and vector tables.

Nothing else in the library imports this subpackage; its queries are in :mod:`loomset.llm.queries`.
"""
