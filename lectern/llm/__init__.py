"""Operators of a training-data pipeline.

Nothing else in the library imports this package; removing it leaves the rest
whole.
"""
