"""Operators for preparing training data: filtering, near-duplicates, extraction, labelling, mixing."""
