"""Operators for preparing large training corpora.

One module per operator; ``queries`` registers them over the driver's tables.
Nothing else in the library imports this package.
"""
