"""Registered queries: each name maps to a callable and, where SQL can say it, to equivalent SQL."""
