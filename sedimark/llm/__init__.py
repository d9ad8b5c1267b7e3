"""Operators for preparing training data from large corpora."""
