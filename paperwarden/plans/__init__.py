"""Whole jobs wired from the operators."""
