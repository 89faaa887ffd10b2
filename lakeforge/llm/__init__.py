"""Operators of a training-data pipeline, each a lazy DataFrame function.

One module per operator; ``catalog`` registers one query per operator.
Nothing else in the library imports this package.
"""
