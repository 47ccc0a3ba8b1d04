"""Operators of a pipeline for training text; nothing else in the library imports them."""
