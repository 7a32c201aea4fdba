"""Queries over the given tables, and their SQL counterparts."""
