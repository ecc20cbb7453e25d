"""Test inputs derived from the given tables."""
