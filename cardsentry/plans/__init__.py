"""Whole jobs over tables, the registered queries and their SQL counterparts."""
