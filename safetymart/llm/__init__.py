"""Operators for preparing training data: each module holds one, by its own method."""
