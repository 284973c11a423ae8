"""Operators for the preparation of training text, each with one registered query."""
