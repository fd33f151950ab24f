"""Operators for large-scale training-data preparation.

Nothing else in the library imports this package; it may be removed as a
whole.  Each module holds one operator, :mod:`hausprep.llm.queries` its
registered queries.
"""
