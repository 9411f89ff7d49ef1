"""Queries over the test tables, and the inputs derived from those."""
