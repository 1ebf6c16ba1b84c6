"""Operators for preparing training data at scale.

Nothing outside this package imports it; ``queries.py`` holds the registered
queries and their oracle SQL.
"""
