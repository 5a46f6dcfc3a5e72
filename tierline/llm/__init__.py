"""Operators for preparing training corpora (one module per operator).

Nothing outside this folder imports it; ``queries.py`` holds the registered
queries and ``oracles.py`` their SQL.
"""
