"""Readers: raw lines, parsed transactions, tables, fixed dimensions."""
