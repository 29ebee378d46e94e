"""Operators of a training-data pipeline over text tables (see README).

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries, one module per operator holds the operator itself.
"""
