"""Operators for building training corpora, and the queries that apply them.

Nothing outside this subpackage imports it.
"""
