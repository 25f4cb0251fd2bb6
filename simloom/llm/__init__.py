"""Operators for training data.  Optional: nothing outside this package imports it."""
