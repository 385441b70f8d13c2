"""Operators for training-data pipelines over documents and web pages.

Nothing outside this subpackage imports it; ``queries.py`` registers one
query per operator.
"""
