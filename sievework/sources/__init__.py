"""Readers for contacts, pages, profiles, answers and the cache."""
