"""Operators of a training-data pipeline: duplicates, classifiers, tokens, leaks, mixing, chat text."""
