"""Operators for the preparation of training text. Nothing else in the library imports this."""
