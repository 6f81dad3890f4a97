"""Operators of a training-data pipeline: de-duplication, tokens, mixing, quality.

Nothing else in the library imports this subpackage.
"""
