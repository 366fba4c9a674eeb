"""Operators for training-data preparation; nothing else in the library imports this package."""
