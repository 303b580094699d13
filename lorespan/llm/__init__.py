"""Operators for preparing training data at scale, their queries and their SQL.

Nothing else in the library imports this package.
"""
