"""Operators of a training-data pipeline over ``documents`` (one module per operator).

Nothing outside this subpackage imports it except the guarded registration in ``__spark_entry__.py``.
"""
