"""Operators for training data and for text; nothing else in the package imports this."""
