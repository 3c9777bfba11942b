"""Brokerage operators.  Each takes ``(tables, scope)`` and returns a lazy DataFrame."""
