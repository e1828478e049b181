"""Operators for preparing training data: one module per operator, and the
registry of the queries that apply them (``queries.py``)."""
