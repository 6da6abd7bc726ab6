"""Operators for large-scale training-data pipelines.

Each module holds one operator with a general interface and the thin query
registered for it. Nothing outside this subpackage imports it.
"""
