"""Relational operators over harvest tables."""
