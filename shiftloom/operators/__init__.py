"""Operators: ``op(params)`` returns a function for ``DataFrame.transform``."""
