"""Readers: files, databases, tables, and the fixed catalogues."""
