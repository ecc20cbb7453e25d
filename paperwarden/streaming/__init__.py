"""Scoring of arriving documents."""
